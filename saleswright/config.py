"""Schemas, word lists and rules that the operators take as parameters.

Lists here are the defaults. Every operator that uses one takes it as an
argument, and ``sources.files`` reads replacements from CSV.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Cell grids

GRID_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("sheet_name", T.StringType()),
        T.StructField("sheet_ordinal", T.IntegerType()),
        T.StructField("row_idx", T.LongType()),
        T.StructField("cells", T.ArrayType(T.StringType())),
    ]
)

# ---------------------------------------------------------------------------
# Ledgers. Field names and types, in order.

BASE_FIELDS = [
    ("transaction_id", "string"),
    ("wholesaler_hq", "string"),
    ("wholesaler_branch_name", "string"),
    ("wholesaler_branch_number", "string"),
    ("contractor_name", "string"),
    ("contractor_number", "string"),
    ("customer_name", "string"),
    ("vendor", "string"),
    ("sales_order_number", "string"),
    ("ordered_on", "date"),
    ("item_sku", "string"),
    ("item_sku_alt", "string"),
    ("item_sku_category", "string"),
    ("item_upc", "string"),
    ("item_description", "string"),
    ("unit_price", "decimal(10,2)"),
    ("ship_quantity", "int"),
    ("uom", "string"),
    ("extended_price", "decimal(10,2)"),
    ("row_id", "int"),
    ("type", "string"),
    ("sheet_name", "string"),
    ("archive_file_name", "string"),
]
CREDIT_FIELDS = [f for f in BASE_FIELDS if f[0] not in ("contractor_name", "contractor_number")]
CREDIT_FIELDS.insert(
    [f[0] for f in CREDIT_FIELDS].index("item_description"), ("material_group_number", "string")
)

WHOLESALER_FIELDS = ["wholesaler_hq", "wholesaler_branch_name", "wholesaler_branch_number"]
AUTO_FIELDS = ["transaction_id", "row_id", "type", "sheet_name", "archive_file_name"]
# A blank description does not make a row blank; it is reported by the checks.
NOT_COUNTED_FOR_BLANK = ["item_description"]
TRANSACTION_TYPE = "unspecified"


@dataclass(frozen=True)
class Ledger:
    """A typed ledger: its fields, and which of them come from the mapping as literals."""

    name: str
    fields: list[tuple[str, str]]
    static: list[str]

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.fields]

    @property
    def mapped(self) -> list[tuple[str, str]]:
        """Fields read from the cells, with their types."""
        return [f for f in self.fields if f[0] not in AUTO_FIELDS and f[0] not in self.static]

    @property
    def data_columns(self) -> list[str]:
        return [n for n, _ in self.mapped]

    @property
    def text_columns(self) -> list[str]:
        return [n for n, t in self.mapped if t == "string"]

    @property
    def schema(self) -> T.StructType:
        row = T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in self.fields))
        row["transaction_id"].nullable = False
        return row


BASE_LEDGER = Ledger(
    "transaction_mapping_base",
    BASE_FIELDS,
    [*WHOLESALER_FIELDS, "contractor_name", "contractor_number"],
)
CREDIT_LEDGER = Ledger("transaction_mapping_credit", CREDIT_FIELDS, WHOLESALER_FIELDS)

# The profiler writes the first spelling, people and the loader use the second.
FIELD_SPELLINGS = {
    "product_description": "item_description",
    "wholesaler_name": "wholesaler_hq",
    "contractor_vendor_number": "contractor_number",
}

PROCESS_VALUES = ["TRUE", "1", "YES", "Y"]
NO_HEADER_VALUES = ["FALSE", "0", "NO", "F"]

# ---------------------------------------------------------------------------
# Template conversion

TEMPLATE_FIELDS = [
    "contractor_name",
    "sales_order_number",
    "order_date",
    "item_sku",
    "item_sku_category",
    "item_upc",
    "item_description",
    "unit_price",
    "ship_quantity",
    "extended_price",
]
TEMPLATE_NUMBERS = ["unit_price", "ship_quantity", "extended_price"]
REQUIRED_FIVE = ["order_date", "item_sku", "item_description", "ship_quantity", "extended_price"]
REQUIRED_TWO = ["item_description", "extended_price"]
TEMPLATE_SHEET = "REPORTED SALES DATA"
SHEET_WORDS = ["detail", "sales", "data", "report"]
TOTAL_WORDS = ["total", "subtotal", "grand total", "totals"]
UNUSABLE_SHEET_WORDS = ["sample", "instructions"]
TEMPLATE_TITLE = "POS Transactional Detail Report"

# Header texts, in normal form, that stand for each template field.
TEMPLATE_ALIASES = {
    "contractor_name": [
        "contractor", "contractor name", "rep", "rep name", "sales rep", "agent", "agent name",
        "name (customer)", "customer name", "customer",
    ],
    "sales_order_number": [
        "sales order", "sales order number", "order number", "so number", "so#", "order#",
        "order count", "po number", "po#", "purchase order", "invoice id", "invoice #",
        "invoice no", "inv id", "inv #", "order no", "order no.",
    ],
    "order_date": [
        "order date", "date", "ship date", "po date", "inv-date", "inv date", "invoice date",
        "invoice-date", "transaction date", "order dt",
    ],
    "item_sku": [
        "sku", "item sku", "item number", "item no", "part number", "part no", "product code",
        "alt1", "alt 1", "alternate 1", "alt#1", "alt-1", "product id", "productid",
        "mfg part #", "mfg part", "mfg #",
    ],
    "item_sku_category": [
        "sku category", "item sku category", "category", "product category", "gph level 4",
    ],
    "item_upc": ["upc", "item upc", "upc code", "barcode", "upc#", "upc (product)"],
    "item_description": [
        "description", "item description", "product description", "product name", "item name",
        "prod description", "prod desc", "name (product)", "product", "item", "product desc",
    ],
    "unit_price": [
        "unit price", "price", "unit cost", "cost", "each", "price line", "list price",
        "sell price",
    ],
    "ship_quantity": [
        "ship quantity", "quantity", "qty", "shipped qty", "units shipped", "units",
        "total quantity", "total qty", "total units", "quantity sold",
    ],
    "extended_price": [
        "extended price", "extended", "ext price", "total price", "amount", "total", "totalnet",
        "total net", "net total", "net amount", "net price", "total amount", "sum price",
        "grand total", "ext. price", "extprice", "sales", "net billings",
    ],
}

# ---------------------------------------------------------------------------
# Payment-run profiling

# Header texts that stand for each credit field; the first listed wins.
CREDIT_ALIASES = {
    "vendor": [
        "Master Vendor Name", "MFR", "VENDOR_NAME", "Vendor", "Manufacturer", "PRIMVDR.NAME",
        "Name (Pay To Vendor)",
    ],
    "customer_name": [
        "CustName", "Customer Name............", "Customer", "CUST NAME",
        "Customer Name - Bill To", "Customer Name", "Customer Name.............",
        "CompanyName-3", "Name (Bill To)", "Customer ID Desc",
        "'Billing Customer'[CustomerName]",
    ],
    "sales_order_number": [
        "e Invoice", "INVOICE#", "Order ID", "ORDER#", "Invoice#......  W", "Invoice Number",
        "Invoice", "Invoice #", "Order Number", "Sales Order Number", "Invoice#",
        "Invoice#......",
    ],
    "ordered_on": [
        "Ship Date", "INV-DATE", "InvDate", "Date", "INVOICE DT", "SHIP DATE", "ShipDate",
        "SHIPDATE", "ShipDate  P", "hipDate  P", "Ship/Rec. Date", "Invoice Date",
    ],
    "item_sku": ["Item Number", "Product ID", "Eclipse Product ID", "Product#"],
    "item_sku_alt": [
        "alt_code", "alt code", "product_number", "product number", "product #", "catalog",
        "alt1", "alt.1", "CatalogNo", "ALT1", "Code (Product)",
    ],
    "item_sku_category": [
        "Sell Group", "Buy Line", "PRICE LINE", "# Inv Lines", "PRC LINE", "Line #: 6.0",
        "Buyline", "Price Line", "Buy Group", "Price Lin",
    ],
    "unit_price": [
        "COST", "Sales  $", "COGS EA", "Amount......", "Unit Price", "UnitPrice", "Sales",
        "Stock Net Unit", "List", "Unit Cost/Ea", "Unit Cost", "COGS Per", "Cost/Item",
    ],
    "ship_quantity": [
        "ship_quantity", "Shipp", "Sum of Quantity Shipped", "QtyShp", "Sum of SHIP QTY",
        "Ship Qty", "y Shipp", "Qty Shipped Ext", "Qty Shipped", "QTY", "Qty/Unit", "Quantity",
        "Qty", "SALE QTY", "Shipped", "SHIP QTY", "Qty Shipp", "Ship  Quantity",
    ],
    "uom": ["uom", "UofM", "UM"],
    "extended_price": [
        "Amount......", "Extension", "TOTALCOST", "COGS", "Sales", "Ext Cost", "Ext Amt",
        "Extension Amount", "EXT COST", "Ext COGS........", "Ext Amount......",
        "Stock Net Ext", "EXT PRICE", "Subtotal", "Sum of EXT ACTUAL COST", "OGS........  G",
        "Ext Cost........", "Amount......  Ext",
    ],
    "product_description": [
        "Description", "Name (Product)", "ProdDesc", "Description 1 (Product)",
        "Product........................", ". Product........................",
        "Product Description", "Product........................    Qt",
        "PRODUCT DESCRIPTION", "Item Description", "DESCRIPTION",
        "Product Description................ Price Lin", "PROD DESC",
        "Product........................    Qty", "Product Description...............",
        "Product", "Product Description................", "PROD DESCRIP",
    ],
    "item_upc": ["PRIMARY UPC#", "UPC (Primary)"],
    "material_group_number": ["MG"],
}

# Fields that take house header names such as "<prefix>_customer", looked for first.
HOUSE_HEADERS = {
    "customer_name": ["customer"],
    "sales_order_number": ["sales_order_number", "invoice_number"],
    "ordered_on": ["ordered_on", "order_date"],
    "item_sku": ["item_sku"],
    "item_sku_category": ["item_sku_category"],
    "ship_quantity": ["quantity_shipped"],
    "extended_price": ["extended_price"],
    "product_description": ["item_description"],
}


def with_house_headers(aliases: dict[str, list[str]], prefix: str) -> dict[str, list[str]]:
    """Aliases with the house names in front."""
    return {
        name: [f"{prefix}_{h}" for h in HOUSE_HEADERS.get(name, [])] + words
        for name, words in aliases.items()
    }


@dataclass(frozen=True)
class LayoutRule:
    """Overrides that apply when all trigger headers are present, compared exactly."""

    triggers: list[str]
    overrides: dict[str, str] = field(default_factory=dict)


# Header layouts of credit files and the columns to use; the first that fits wins.
LAYOUT_RULES = [
    LayoutRule(["Sum of Sales", "COGS"], {"extended_price": "COGS"}),
    LayoutRule(
        ["LIST", "Unit Price", "Reclaim Price", "Difference", "Ext Difference", "Unit COGS",
         "COGS", "Last Cost"],
        {"unit_price": "Unit Price"},
    ),
    LayoutRule(
        ["CLAIM %", "Sum of SHIP QTY", "Sum of EXT ACTUAL COST", "Sum of CLAIM NET",
         "Sum of EXT CLAIM"],
        {"extended_price": "Sum of EXT ACTUAL COST"},
    ),
    LayoutRule(
        ["Ext Amount......", "Ext COGS........", "GP$..........", "GP%...."],
        {"extended_price": "Ext COGS........"},
    ),
    LayoutRule(
        ["Unit Price", "Sales", "Unit Cost", "Ext Cost"],
        {"unit_price": "Unit Cost", "extended_price": "Ext Cost"},
    ),
    LayoutRule(["Qty", "Sales", "COGS GP"], {"extended_price": "Sales"}),
    LayoutRule(
        ["Sales", "COGS GP", "COGS", "COGS EA", "Quote", "Difference"],
        {"extended_price": "COGS", "unit_price": "COGS EA"},
    ),
    LayoutRule(
        ["__PRC.BR__", "RELEASE NUMBER", "PRC LINE", "COGS Per", "Quote", "Difference",
         "Extended Price"],
        {"unit_price": "COGS Per"},
    ),
    LayoutRule(["List", "Ship Qty", "Multiplier", "Extension"], {"extended_price": "Extension"}),
    LayoutRule(
        ["126 List", "Stock Net Unit", "Stock Net Ext", "Credit %", "Credit"],
        {"unit_price": "Stock Net Unit", "extended_price": "Stock Net Ext"},
    ),
    LayoutRule(["ShipDate", "Qty", "Sales", "COGS"], {"extended_price": "COGS"}),
]

HEADER_SCAN_ROWS = 10
HEADER_MIN_SHARE = 0.3
FALLBACK_SCAN_ROWS = 20


@dataclass(frozen=True)
class ProfileVariant:
    """How the payment-run profiler reads a sheet."""

    name: str
    # Headers of one character are not looked up.
    skip_single_letters: bool
    # The data range starts at the header row (base) or at the first dense row (credit).
    range_from_header: bool
    # Share of filled cells a data row needs; None derives it from the header.
    row_share: float | None
    fields: list[str]
    extra: list[str]


PROFILE_FIELDS = [
    "vendor", "customer_name", "sales_order_number", "ordered_on", "item_sku", "item_sku_alt",
    "item_sku_category", "item_upc", "product_description", "unit_price", "ship_quantity", "uom",
    "extended_price",
]
BASE_PROFILE = ProfileVariant(
    "base", True, True, None, PROFILE_FIELDS,
    ["submitted_by", "contractor_vendor_number", "contractor_name", "wholesaler_vendor_number",
     "wholesaler_name"],
)
CREDIT_PROFILE = ProfileVariant(
    "credit", False, False, 0.5,
    [*PROFILE_FIELDS[:8], "material_group_number", *PROFILE_FIELDS[8:]],
    ["wholesaler_hq", "wholesaler_branch_name", "wholesaler_branch_number"],
)

# ---------------------------------------------------------------------------
# Audits

# Keyword, category, priority.
CATEGORY_KEYWORDS = [
    ("tubing", "pipe", 1), ("conduit", "pipe", 1), ("hose", "pipe", 1), ("tube", "pipe", 1),
    ("solid", "pipe", 2), ("elbow", "fitting", 1), ("tee", "fitting", 1),
    ("coupling", "fitting", 1), ("union", "fitting", 1), ("valve", "fitting", 1),
    ("connector", "fitting", 1), ("adapter", "fitting", 1), ("reducer", "fitting", 1),
    ("cap", "fitting", 1), ("plug", "fitting", 1), ("flange", "fitting", 1),
    ("fitting", "fitting", 1), ("inc/red", "fitting", 1), ("bushing", "fitting", 1),
    ("bush", "fitting", 1), ("wyes", "fitting", 1), ("increaser", "fitting", 1),
]
# Category, the flag column that should be set, and the word used for it in the message.
CATEGORY_FLAGS = [("pipe", "pipe"), ("fitting", "fittings")]
TRUE_FLAGS = ["y", "1", "true"]
FLAG_COLUMNS = [
    "cast_iron", "plastic", "pipe", "fittings", "pvc", "abs", "dwv", "cpvc", "cts", "neither",
    "questionable", "exclude",
]

# Words that mean a line is not covered; the first listed is reported.
EXCLUSION_TERMS = ["copper", "spears", "tyler", "JM eagle", "lasco", "ipex", "nibco"]

# ---------------------------------------------------------------------------
# Records and documents

# Names under which a service may put its list of records, in order.
ENVELOPE_NAMES = ["data", "results", "items", "records", "list"]

DOCUMENT_SCHEMA = (
    "participant_key string, request_id string, properties array<string>, "
    "entities array<struct<id: string, properties: array<string>, "
    "transactions: array<struct<transaction_id: string, transaction_type: string, "
    "sku_key: string, uom_key: string, quantity: double, amount: double, "
    "invoice_date: string, properties: array<string>, "
    "purchaser: struct<id: string>, seller: struct<key: string>>>>>, "
    "relationships array<string>"
)

DEFAULT_TRANSACTION_TYPE = "retailer_purchases_from_distribution"
DEFAULT_UOM = "oz"
DEFAULT_TARGET_PERCENT = 95.0
