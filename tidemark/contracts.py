"""Declared table contracts: one place that states column types, keys,
foreign keys, value domains, row checks and allowed transitions.

Everything else (warehouse schemas, payload parsing, the schema gate, the
quality rules, quarantine) is generated from these objects.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TS = T.TimestampNTZType()
STR = T.StringType()
LONG = T.LongType()
INT = T.IntegerType()
DOUBLE = T.DoubleType()
BOOL = T.BooleanType()

# Operation codes of a change event (fixed values of the change feed format).
OPERATIONS = ("insert", "update", "delete")

# Lake record layout.  sequence is 64-bit (the reference used 32-bit).
LAKE_SCHEMA = T.StructType([
    T.StructField("sequence", LONG, False),
    T.StructField("operation", STR, False),
    T.StructField("table_name", STR, False),
    T.StructField("primary_key", STR, False),
    T.StructField("data", STR, False),
    T.StructField("captured_at", TS, False),
])
LAKE_COLUMNS = [f.name for f in LAKE_SCHEMA.fields]
# Columns the library adds to stored lake rows.
INGEST_BATCH = "_ingest_batch"
RESTORE_NO = "_restore_no"
CDC_SEQ = "_cdc_seq"
DELETED = "_deleted"


@dataclass(frozen=True)
class Column:
    name: str
    dtype: T.DataType
    nullable: bool = True
    domain: tuple[str, ...] | None = None
    default: object | None = None  # literal filled in on source ingest when the column is absent


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Check:
    """Row rule: ``violation`` is a SQL predicate that is TRUE for a bad row
    (NULL counts as not violated, as with a SQL CHECK)."""
    rule_id: str
    column: str
    rule_type: str
    violation: str
    message: str = ""


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[Column, ...]
    pk: tuple[str, ...]
    fks: tuple[ForeignKey, ...] = ()
    checks: tuple[Check, ...] = ()
    # column -> allowed (from, to) pairs; from None means "first value"
    transitions: dict[str, tuple[tuple[str | None, str], ...]] = field(default_factory=dict)
    description: str = ""

    @property
    def wh_name(self) -> str:
        return f"wh_{self.name}"

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, c.nullable) for c in self.columns])

    @property
    def payload_struct(self) -> T.StructType:
        """Payload parse schema: every column nullable, contract types."""
        return T.StructType([T.StructField(c.name, c.dtype, True) for c in self.columns])

    @property
    def warehouse_struct(self) -> T.StructType:
        fields = [T.StructField(c.name, c.dtype, c.name in self.pk) for c in self.columns]
        fields += [T.StructField(CDC_SEQ, LONG, False), T.StructField(DELETED, BOOL, False)]
        return T.StructType(fields)

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"{self.name}.{name}")

    @property
    def single_pk(self) -> str:
        if len(self.pk) != 1:
            raise ValueError(f"{self.name} has a composite key {self.pk}")
        return self.pk[0]


@dataclass(frozen=True)
class Contract:
    tables: tuple[TableContract, ...]
    name: str = "contract"

    def table(self, name: str) -> TableContract:
        for t in self.tables:
            if t.name == name:
                return t
        raise KeyError(name)

    @property
    def names(self) -> list[str]:
        return [t.name for t in self.tables]

    def __contains__(self, name: str) -> bool:
        return name in self.names

    def columns_by_table(self) -> dict[str, list[str]]:
        return {t.name: t.column_names for t in self.tables}


def _c(name, dtype, nullable=True, domain=None, default=None) -> Column:
    return Column(name, dtype, nullable, tuple(domain) if domain else None, default)


# ---------------------------------------------------------------------------
# Payments contract (the reference's source system).  Fixed values: table
# names, column names, enum domains and money rules of that system.
# ---------------------------------------------------------------------------
PAYMENTS = Contract(name="payments", tables=(
    TableContract(
        "customers",
        (
            _c("customer_id", STR, False),
            _c("name", STR, False),
            _c("email", STR, False),
            _c("status", STR, False, ("active", "suspended", "closed")),
            _c("created_at", TS, False),
            _c("updated_at", TS, False),
        ),
        pk=("customer_id",),
        description="Customer account profiles",
    ),
    TableContract(
        "wallets",
        (
            _c("wallet_id", STR, False),
            _c("customer_id", STR, False),
            _c("balance", MONEY, False, default="0.00"),
            _c("currency", STR, False),
            _c("status", STR, False, ("active", "frozen", "closed")),
            _c("created_at", TS, False),
            _c("updated_at", TS, False),
        ),
        pk=("wallet_id",),
        fks=(ForeignKey("customer_id", "customers", "customer_id"),),
        checks=(Check("balance_nonnegative", "balance", "nonnegative", "balance < 0",
                      "row(s) have negative wallet balance"),),
        description="Balance containers owned by customers",
    ),
    TableContract(
        "merchants",
        (
            _c("merchant_id", STR, False),
            _c("name", STR, False),
            _c("email", STR, False),
            _c("status", STR, False, ("active", "inactive")),
            _c("created_at", TS, False),
        ),
        pk=("merchant_id",),
        description="Business counterparties",
    ),
    TableContract(
        "transactions",
        (
            _c("transaction_id", STR, False),
            _c("wallet_id", STR, False),
            _c("merchant_id", STR, True),
            _c("amount", MONEY, False),
            _c("fee", MONEY, False, default="0.00"),
            _c("direction", STR, False, ("credit", "debit")),
            _c("status", STR, False, ("pending", "settled", "failed", "reversed")),
            _c("reference", STR, True),
            _c("created_at", TS, False),
            _c("settled_at", TS, True),
        ),
        pk=("transaction_id",),
        fks=(ForeignKey("wallet_id", "wallets", "wallet_id"),
             ForeignKey("merchant_id", "merchants", "merchant_id")),
        checks=(
            Check("amount_fee_valid", "amount", "amount_fee", "amount <= 0 OR fee < 0",
                  "row(s) have invalid transaction amount or fee"),
            Check("settled_after_created", "settled_at", "time_order",
                  "settled_at IS NOT NULL AND settled_at < created_at",
                  "row(s) have settled_at timestamp preceding created_at"),
        ),
        transitions={"status": (
            (None, "pending"), (None, "settled"), (None, "failed"),
            ("pending", "pending"), ("pending", "settled"), ("pending", "failed"),
            ("settled", "settled"), ("settled", "reversed"),
            ("failed", "failed"), ("reversed", "reversed"),
        )},
        description="Payment lifecycle events",
    ),
    TableContract(
        "ledger_entries",
        (
            _c("entry_id", STR, False),
            _c("transaction_id", STR, False),
            _c("wallet_id", STR, False),
            _c("entry_type", STR, False, ("debit", "credit")),
            _c("amount", MONEY, False),
            _c("balance_after", MONEY, False),
            _c("created_at", TS, False),
        ),
        pk=("entry_id",),
        fks=(ForeignKey("transaction_id", "transactions", "transaction_id"),
             ForeignKey("wallet_id", "wallets", "wallet_id")),
        checks=(
            Check("amount_positive", "amount", "positive", "amount <= 0",
                  "row(s) have non-positive ledger amount"),
            Check("balance_after_nonnegative", "balance_after", "nonnegative", "balance_after < 0",
                  "row(s) have negative balance_after"),
        ),
        description="Double-entry ledger lines",
    ),
))


# ---------------------------------------------------------------------------
# Contract of the change feed derived from the driver's ``events`` table
# (see tidemark.sources.testdata): two entity tables keyed by user_id.
# ---------------------------------------------------------------------------
def _feed_table(name: str) -> TableContract:
    return TableContract(
        name,
        (
            _c("user_id", LONG, False),
            _c("event_type", STR, False, ("signup", "click", "view", "purchase", "error")),
            _c("value", MONEY, True),
            _c("k", LONG, True),
        ),
        pk=("user_id",),
        checks=(Check(f"{name}_value_nonnegative", "value", "nonnegative", "value < 0",
                      "row(s) have negative value"),),
        transitions={"operation": (
            (None, "insert"), (None, "update"), (None, "delete"),
            ("insert", "update"), ("insert", "delete"),
            ("update", "update"), ("update", "delete"),
            ("delete", "insert"), ("delete", "delete"),
        )},
        description=f"Current state of {name} rebuilt from the event feed",
    )


FEED = Contract(name="events_feed", tables=(_feed_table("accounts"), _feed_table("devices")))


# ---------------------------------------------------------------------------
# Contract of the driver's relational tables (TPC-H-like star schema).
# ---------------------------------------------------------------------------
TESTDATA = Contract(name="testdata", tables=(
    TableContract("region", (_c("r_regionkey", INT, False), _c("r_name", STR, False)),
                  pk=("r_regionkey",)),
    TableContract("nation", (_c("n_nationkey", INT, False), _c("n_name", STR, False),
                             _c("n_regionkey", INT, False)),
                  pk=("n_nationkey",), fks=(ForeignKey("n_regionkey", "region", "r_regionkey"),)),
    TableContract("customer", (
        _c("c_custkey", LONG, False), _c("c_name", STR, False), _c("c_nationkey", INT, False),
        _c("c_acctbal", DOUBLE, False), _c("c_mktsegment", STR, False)),
        pk=("c_custkey",), fks=(ForeignKey("c_nationkey", "nation", "n_nationkey"),),
        checks=(Check("c_acctbal_nonnegative", "c_acctbal", "nonnegative", "c_acctbal < 0",
                      "row(s) have negative account balance"),)),
    TableContract("supplier", (
        _c("s_suppkey", LONG, False), _c("s_name", STR, False), _c("s_nationkey", INT, False),
        _c("s_acctbal", DOUBLE, False)),
        pk=("s_suppkey",), fks=(ForeignKey("s_nationkey", "nation", "n_nationkey"),)),
    TableContract("part", (
        _c("p_partkey", LONG, False), _c("p_name", STR, False), _c("p_brand", STR, False),
        _c("p_type", STR, False), _c("p_size", INT, False), _c("p_retailprice", DOUBLE, False)),
        pk=("p_partkey",),
        checks=(Check("p_retailprice_positive", "p_retailprice", "positive", "p_retailprice <= 0",
                      "row(s) have non-positive retail price"),)),
    TableContract("orders", (
        _c("o_orderkey", LONG, False), _c("o_custkey", LONG, False),
        _c("o_orderstatus", STR, False, ("F", "O")), _c("o_totalprice", DOUBLE, False),
        _c("o_orderdate", TS, False), _c("o_orderpriority", STR, False)),
        pk=("o_orderkey",), fks=(ForeignKey("o_custkey", "customer", "c_custkey"),),
        checks=(Check("o_totalprice_positive", "o_totalprice", "amount_fee", "o_totalprice <= 0",
                      "row(s) have non-positive order total"),)),
    TableContract("lineitem", (
        _c("l_orderkey", LONG, False), _c("l_partkey", LONG, False), _c("l_suppkey", LONG, False),
        _c("l_linenumber", INT, False), _c("l_quantity", DOUBLE, False),
        _c("l_extendedprice", DOUBLE, False), _c("l_discount", DOUBLE, False),
        _c("l_tax", DOUBLE, False), _c("l_returnflag", STR, False, ("A", "N", "R")),
        _c("l_linestatus", STR, False, ("F", "O")), _c("l_shipdate", TS, False)),
        pk=("l_orderkey", "l_linenumber"),
        fks=(ForeignKey("l_orderkey", "orders", "o_orderkey"),
             ForeignKey("l_partkey", "part", "p_partkey"),
             ForeignKey("l_suppkey", "supplier", "s_suppkey")),
        checks=(Check("l_amount_discount_valid", "l_extendedprice", "amount_fee",
                      "l_extendedprice <= 0 OR l_discount < 0",
                      "row(s) have invalid line amount or discount"),)),
))


def retyped(contract: Contract, column: str, dtype: T.DataType, name: str | None = None) -> Contract:
    """The same contract with ``column`` declared as ``dtype`` in every table
    that has it (models a contract revision the upstream does not follow)."""
    tables = []
    for t in contract.tables:
        cols = tuple(Column(c.name, dtype, c.nullable, c.domain, c.default) if c.name == column else c
                     for c in t.columns)
        tables.append(TableContract(t.name, cols, t.pk, t.fks, t.checks, t.transitions, t.description))
    return Contract(tuple(tables), name or f"{contract.name}_retyped")


def extended(contract: Contract, extra: dict[str, tuple[Column, ...]], name: str | None = None) -> Contract:
    """The same contract expecting more columns in some tables."""
    tables = []
    for t in contract.tables:
        cols = t.columns + tuple(extra.get(t.name, ()))
        tables.append(TableContract(t.name, cols, t.pk, t.fks, t.checks, t.transitions, t.description))
    return Contract(tuple(tables), name or f"{contract.name}_extended")


# The standard TPC-H columns of lineitem and orders that the
# driver's trimmed tables do not ship (a source that dropped columns).
TPCH_STANDARD = extended(TESTDATA, {
    "lineitem": (_c("l_commitdate", TS, False), _c("l_receiptdate", TS, False),
                 _c("l_shipinstruct", STR, False), _c("l_shipmode", STR, False), _c("l_comment", STR, False)),
    "orders": (_c("o_clerk", STR, False), _c("o_shippriority", INT, False), _c("o_comment", STR, False)),
}, name="tpch_standard")
