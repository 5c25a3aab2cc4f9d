"""The queries of the operators, and their oracles where SQL can express them."""

from saleswright.llm import queries_rows, queries_search, queries_text

QUERIES, ORACLES = {}, {}
for _part in (queries_rows, queries_text, queries_search):
    for _name, (_query, _oracle) in _part.ALL.items():
        QUERIES[_name] = _query
        if _oracle is not None:
            ORACLES[_name] = _oracle
