"""All queries and oracles."""

from workload import audits, cells, documents, ledgers, programs, sheets, stores

QUERIES, ORACLES = {}, {}
for _part in (cells, ledgers, audits, sheets, documents, programs, stores):
    for _name, (_query, _oracle) in _part.ALL.items():
        QUERIES[_name] = _query
        if _oracle is not None:
            ORACLES[_name] = _oracle
