"""The sales warehouse: exports -> landing (src) -> stage -> mart report.

Layer shapes (the stage tables carry ``id`` and the audit columns):

* src.sales: dt, company, counterparty, contract, nomenclature, quantity, amount
* src.counterparties: company, taxpayer_identification_number, full_name_company
* src.contracts: contract, counterparty, type_contract, currency, company
* src.nomenclature: nomenclature
* stage.sales: id, dt, company, counterparty, contract, nomenclature (ids),
  quantity, amount, audit columns
* mart report: company, counterparty, contract, nomenclature, total_quantity,
  total_amount

Every function maps DataFrames to DataFrames; ``WarehouseJob`` adds the reads
and writes: a load writes fresh folders and is published by one small entry.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starload.functions.dates import parse_timestamp
from starload.functions.numbers import parse_number
from starload.functions.sql_functions import create_report_view
from starload.functions.text import clean_all_text
from starload.operators.aggregates import sum_by
from starload.operators.filters import contains_all, contains_any, is_true
from starload.operators.joins import hash_side, left_lookup, may_broadcast, orphans
from starload.operators.keys import assign_keys_unordered
from starload.operators.quality import require_empty, require_length, require_not_null
from starload.operators.setops import union_all
from starload.operators.upsert import (
    expire_unseen,
    flag_range,
    initial_load,
    replace_range,
    upsert,
    with_audit,
)
from starload.sinks.files import export_csv
from starload.sinks.notes import list_notes
from starload.sinks.tables import (
    Entries,
    PeriodFolders,
    new_tag,
    read_bucketed,
    remove_folders,
    write_bucketed,
)
from starload.sources.files import REJECTED, read_delimited, read_delimited_lenient, read_first_column

# Phrases that select sales rows in the accounting export.
SALES_OPERATION_PHRASES = ["Реализация товаров", "Реализация продукции"]
SALES_DOCUMENT_PHRASE = "акт, накладная, УПД"

# Export column names, by position.
SALES_EXPORT_COLUMNS = [
    "dt",
    "accounting_document",
    "company",
    "counterparty",
    "contract",
    "accounting_document_",
    "quantity",
    "nomenclature_group",
    "tax_rate",
    "nomenclature",
    "amount",
    "contents_operation",
]
COUNTERPARTY_EXPORT_COLUMNS = ["company", "taxpayer_identification_number", "full_name_company"]
CONTRACT_EXPORT_COLUMNS = ["contract", "counterparty", "type_contract", "currency", "company"]

SRC_SALES_COLUMNS = ["dt", "company", "counterparty", "contract", "nomenclature", "quantity", "amount"]


def _all_text(names) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


SALES_EXPORT_SCHEMA = _all_text(SALES_EXPORT_COLUMNS)
COUNTERPARTY_EXPORT_SCHEMA = _all_text(COUNTERPARTY_EXPORT_COLUMNS)
CONTRACT_EXPORT_SCHEMA = _all_text(CONTRACT_EXPORT_COLUMNS)


# --------------------------------------------------------------------- exports


def _selected_sales(raw: DataFrame) -> DataFrame:
    """The rows that the export job takes: its two text filters, on the raw text."""
    return raw.where(contains_any("contents_operation", SALES_OPERATION_PHRASES)).where(
        contains_all("accounting_document", [SALES_DOCUMENT_PHRASE])
    )


def _sales_values(strict: bool) -> dict[str, Column]:
    """The typed columns of a sales row."""
    numbers = {c: parse_number(c, strict=strict) for c in ("quantity", "amount")}
    return {
        "dt": parse_timestamp("dt", strict=strict),
        **{c: n.cast("int") if strict else n.try_cast("int") for c, n in numbers.items()},
    }


def cleanse_sales(raw: DataFrame) -> DataFrame:
    """Sales export rows -> src.sales.

    Order as in the export job: the two text filters on the raw text, then
    numbers, then whitespace cleanup of every text column, then projection.
    """
    values = _sales_values(strict=True)
    typed = _selected_sales(raw).select(
        values["dt"].alias("dt"),
        *[c for c in raw.columns if c not in values],
        values["quantity"].alias("quantity"),
        values["amount"].alias("amount"),
    )
    return clean_all_text(typed).select(*SRC_SALES_COLUMNS)


def split_sales(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``raw`` whose date and numbers can be read, and the others, of
    those that the export job takes."""
    bad = F.lit(False)
    for c, value in _sales_values(strict=False).items():
        bad = bad | (F.col(c).isNotNull() & value.isNull())
    rows = _selected_sales(raw)
    return rows.where(~bad), rows.where(bad)


def cleanse_counterparties(raw: DataFrame) -> DataFrame:
    """The tax number is kept as text, untouched (leading zeros matter)."""
    return clean_all_text(raw, exclude=["taxpayer_identification_number"])


def cleanse_contracts(raw: DataFrame) -> DataFrame:
    return clean_all_text(raw)


def cleanse_nomenclature(raw: DataFrame) -> DataFrame:
    return clean_all_text(raw)


@dataclass
class Exports:
    sales: DataFrame
    counterparties: DataFrame
    contracts: DataFrame
    nomenclature: DataFrame
    #: ``table, line`` of what could not be read, if that is kept apart
    rejects: DataFrame | None = None


def _line_of(table: str, rows: DataFrame, column: Column) -> DataFrame:
    return rows.select(F.lit(table).alias("table"), column.alias("line"))


def read_exports(
    spark: SparkSession,
    sales_path: str,
    counterparties_path: str,
    contracts_path: str,
    nomenclature_path: str,
    nomenclature_skip_rows: int = 1,
    keep_rejects: bool = False,
) -> Exports:
    """Read the four tab-separated exports and cleanse them.

    A line with too few or too many fields, or a sale whose date or numbers cannot
    be read, stops the load; with ``keep_rejects`` such lines become the table
    ``rejects`` and the load takes the others.
    """
    files = {
        "sales": (sales_path, SALES_EXPORT_SCHEMA),
        "counterparties": (counterparties_path, COUNTERPARTY_EXPORT_SCHEMA),
        "contracts": (contracts_path, CONTRACT_EXPORT_SCHEMA),
    }
    rejects = None
    if keep_rejects:
        raw, lines = {}, []
        for name, (path, schema) in files.items():
            raw[name], bad = read_delimited_lenient(spark, path, schema)
            lines.append(_line_of(name, bad, F.col(REJECTED)))
        raw["sales"], bad = split_sales(raw["sales"])
        whole = F.array_join(F.array(*[F.col(c) for c in SALES_EXPORT_COLUMNS]), "\t", "")
        rejects = union_all([*lines, _line_of("sales", bad, whole)])
    else:
        raw = {name: read_delimited(spark, path, schema) for name, (path, schema) in files.items()}
    nomenclature = read_first_column(
        spark, nomenclature_path, "nomenclature", skip_rows=nomenclature_skip_rows
    )
    return Exports(
        cleanse_sales(raw["sales"]),
        cleanse_counterparties(raw["counterparties"]),
        cleanse_contracts(raw["contracts"]),
        cleanse_nomenclature(nomenclature),
        rejects,
    )


TABLES = ("sales", "counterparties", "contracts", "nomenclature")


def together(tasks: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Runs jobs that do not depend on each other side by side, so that a short
    one's tasks fill the cores that another one leaves; the first error raises."""
    with ThreadPoolExecutor(max(1, len(tasks))) as pool:
        found = {name: pool.submit(task) for name, task in tasks.items()}
        return {name: f.result() for name, f in found.items()}


def land_exports(src: Exports, root: str, seen: dict[str, int] | None = None) -> Exports:
    """Write the cleansed exports as the landing (src) tables and read them
    back, so later steps scan files instead of recomputing the cleansing.

    ``seen`` takes the number of rows of each table that break one of its rules
    (``REQUIRED``, ``LIMITS``); they are counted while the rows are written.
    """
    spark = src.sales.sparkSession

    def land(name: str) -> DataFrame:
        rows, broken = getattr(src, name), F.lit(False)
        for c in REQUIRED.get(name, ()):
            broken = broken | F.col(f"`{c}`").isNull()
        for c, n in LIMITS.get(name, {}).items():
            broken = broken | (F.coalesce(F.length(F.col(f"`{c}`")), F.lit(0)) > n)
        path = f"{root.rstrip('/')}/{name}"
        if name == "rejects":
            rows.write.mode("overwrite").parquet(path)
            return spark.read.schema(rows.schema).parquet(path)
        if seen is None:
            rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
        else:
            count = Observation()
            rows.observe(count, F.count_if(broken).alias("broken")).write.mode("overwrite").option(
                "compression", "zstd").parquet(path)
            seen[name] = count.get["broken"]
        return spark.read.schema(rows.schema).parquet(path)

    names = TABLES if src.rejects is None else (*TABLES, "rejects")
    return Exports(**together({name: partial(land, name) for name in names}))


# ----------------------------------------------------------------------- stage


@dataclass
class Stage:
    counterparties: DataFrame
    contracts: DataFrame
    nomenclature: DataFrame
    sales: DataFrame


def resolve_facts(src_sales: DataFrame, counterparties: DataFrame, contracts: DataFrame,
                  nomenclature: DataFrame) -> DataFrame:
    """Natural keys -> stage ids (M5).

    Company and counterparty both resolve against the counterparty dimension
    (two roles of one table); the contract needs the composite key
    (contract, company, counterparty).  Left joins: an unknown name leaves a
    NULL id and the fact is still loaded.  ``is_actual`` of the dimensions is
    not consulted, and a repeated dimension key fans out, as the SQL does.

    Plan: four chained lookups.  Counterparties, contracts and items are
    reference tables, small next to the sales, so the planner broadcasts
    them (its size checks decide) and the facts are not shuffled at all; a
    dimension too large to broadcast is joined by key, with AQE splitting a
    hot key on the fact side.
    """
    f = src_sales.select(
        "*",
        F.col("company").alias("__company_name"),
        F.col("counterparty").alias("__counterparty_name"),
        F.col("contract").alias("__contract_name"),
    )
    f = left_lookup(f, counterparties, {"__company_name": "company"}, {"id": "company"})
    f = left_lookup(f, counterparties, {"__counterparty_name": "company"}, {"id": "counterparty"})
    f = left_lookup(
        f,
        contracts,
        [("__contract_name", "contract"), ("__company_name", "company"),
         ("__counterparty_name", "counterparty")],
        {"id": "contract"},
    )
    f = left_lookup(f, nomenclature, {"nomenclature": "nomenclature"}, {"id": "nomenclature"})
    return f.select(
        "dt",
        F.col("company").cast("int").alias("company"),
        F.col("counterparty").cast("int").alias("counterparty"),
        F.col("contract").cast("int").alias("contract"),
        F.col("nomenclature").cast("int").alias("nomenclature"),
        "quantity",
        "amount",
    )


#: Names that are looked at as possibly hot, of each kind, and the share of the
#: rows from which one is; slices over which the rows of a hot name are spread.
HOT_NAMES, HOT_SHARE, SLICES = 64, 1 / 64, 64

#: Items that ``resolve_facts_shared`` sends to all tasks at most, and the number of
#: combinations, as a share of the facts, from which it resolves fact by fact.
FEW_ITEMS, OWN_SHARE = 100_000, 1 / 2

_NAMES = ("company", "counterparty", "contract", "nomenclature")


def hot_values(rows: DataFrame, columns: dict[str, Column], seen: dict[str, int] | None = None) -> dict[str, list]:
    """Of each column the values on ``HOT_SHARE`` of the rows or more, None among them,
    found in one pass by frequent-item sketches; at most ``HOT_NAMES`` and None each,
    for the driver.  ``seen`` takes the number of rows, and about how many different
    values the columns have that it names."""
    seen = {} if seen is None else seen
    sketches = rows.select(*[c.alias(name) for name, c in columns.items()]).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"approx_top_k({name}, {HOT_NAMES}, {16 * HOT_NAMES})").alias(name) for name in columns],
        *[F.count(name).alias(f"{name}_filled") for name in columns],
        *[F.approx_count_distinct(name).alias(f"{name}_distinct") for name in columns if name in seen],
    ).first()
    least = max(1, sketches["n"] * HOT_SHARE)
    seen |= {"n": sketches["n"], **{name: sketches[f"{name}_distinct"] for name in columns if name in seen}}
    found = {name: [x["item"] for x in sketches[name] or [] if x["count"] >= least and x["item"] is not None]
             for name in columns}
    return {name: hot + [None] * (sketches["n"] - sketches[f"{name}_filled"] >= least)
            for name, hot in found.items()}


def _is_one(key: Column, hot: list) -> Column:
    some = key.isin([x for x in hot if x is not None])
    return some | key.isNull() if None in hot else some


def _sliced_lookup(rows: DataFrame, dim: DataFrame, on: list[tuple[str, str]], take: dict[str, str],
                   hot: list, key: Column, dim_key: Column) -> DataFrame:
    """``left_lookup`` with the rows of hot keys spread over slices, for each of
    which the few dimension rows of these keys are repeated.  A missing key meets
    nothing in any slice."""
    if not hot:
        return left_lookup(rows, dim, on, take)
    side = dim.select("*", _copies(dim_key.isin([x for x in hot if x is not None])).alias("__slice"))
    spread = rows.withColumn("__spread", _slice(rows, _is_one(key, hot)))
    return left_lookup(spread, side, [*on, ("__spread", "__slice")], take).drop("__spread")


def _slice(rows: DataFrame, hot: Column) -> Column:
    others = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    return F.when(hot, F.pmod(others, F.lit(SLICES))).otherwise(0).cast("int")


def _copies(hot: Column) -> Column:
    return F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SLICES - 1))).otherwise(F.array(F.lit(0))))


def resolve_facts_shared(src_sales: DataFrame, counterparties: DataFrame, contracts: DataFrame,
                         nomenclature: DataFrame) -> DataFrame:
    """``resolve_facts`` for dimensions that are too large to broadcast.

    Chained lookups would send the facts through an exchange for each, on names of
    which one may be on a third of the rows.  Here the distinct combinations of
    company, counterparty and contract are resolved by themselves, and the facts meet
    them in one exchange for all three lookups.  The combinations stay in the
    partitions that made them distinct: contracts and facts come to them there.  Where
    most facts have a combination of their own (``OWN_SHARE``), that would send as many
    rows twice, and the facts go through the three lookups themselves.  Items
    are sent to all tasks if they are counted to be few (``FEW_ITEMS``).  Hot names, and
    hot combinations, are found by sketches in a pass over the names and spread over
    slices, so no task gets a third of the rows.  Results are those of
    ``resolve_facts``: unknown names give NULL, repeated dimension keys fan out.
    """
    names = _NAMES[:3]
    few = nomenclature.limit(FEW_ITEMS + 1).count() <= FEW_ITEMS
    seen = {"combination": 0}
    hot = hot_values(src_sales, {
        **{c: F.col(c) for c in (names if few else _NAMES)}, "combination": F.xxhash64(*names)}, seen)
    contracts, counterparties = hash_side(contracts), hash_side(counterparties)
    items = F.broadcast(nomenclature.select("id", "nomenclature")) if few else nomenclature
    facts = _sliced_lookup(src_sales, items, [("nomenclature", "nomenclature")], {"id": "nomenclature_id"},
                           hot.get("nomenclature", []), F.col("nomenclature"), F.col("nomenclature"))
    if seen["combination"] > seen["n"] * OWN_SHARE:
        found = _sliced_lookup(facts.drop("nomenclature"), contracts, [(c, c) for c in ("contract", *names[:2])],
                               {"id": "contract_id"}, hot["combination"], F.xxhash64(*names), F.xxhash64(*names))
        for role in names[:2]:
            found = _sliced_lookup(found.drop("contract"), counterparties, [(role, "company")],
                                   {"id": f"{role}_id"}, hot[role], F.col(role), F.col("company")).drop(role)
        return _of_ids(found)
    # a missing name is one of a combination's values, so it has to meet itself
    missing = reduce(lambda a, b: a + b, [
        F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(names)])
    hot_key = F.xxhash64(*names).isin(hot["combination"])
    sliced = ["__part"] if hot["combination"] else []
    facts = facts.select(
        "dt", "quantity", "amount", "nomenclature_id", missing.alias("__missing"),
        *[F.coalesce(c, F.lit("")).alias(f"__{c}") for c in names],
        *[_slice(src_sales, hot_key).alias(c) for c in sliced])
    key = [*[f"__{c}" for c in names], "__missing", *sliced]
    f = facts.select(*key).distinct()
    # a contract that lacks a name is nobody's: -1 meets no combination
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])
    side = contracts.select(
        "id", *[F.coalesce(c, F.lit("")).alias(f"__{c}") for c in names],
        F.when(whole, 0).otherwise(-1).alias("__missing"), *[_copies(hot_key).alias(c) for c in sliced])
    f = left_lookup(f, side, key, {"id": "contract_id"})
    for i, role in enumerate(names[:2]):
        name = F.when(F.col("__missing").bitwiseAND(F.lit(1 << i)) == 0, F.col(f"__{role}"))
        f = _sliced_lookup(f.withColumn("__name", name), counterparties, [("__name", "company")],
                           {"id": f"{role}_id"}, hot[role], F.col("__name"), F.col("company")).drop("__name")
    return _of_ids(left_lookup(facts, hash_side(f, seen["combination"]), key, [f"{c}_id" for c in names]))


def _of_ids(found: DataFrame) -> DataFrame:
    return found.select("dt", *[F.col(f"{c}_id").cast("int").alias(c) for c in _NAMES], "quantity", "amount")


FACT_ORDER = ["dt", "company", "counterparty", "contract", "nomenclature", "quantity", "amount"]


def _keep(name: str, df: DataFrame) -> DataFrame:
    return df


def _same(df: DataFrame) -> DataFrame:
    return df


def stage_initial_load(
    src: Exports,
    load_ts,
    persist: Callable[[str, DataFrame], DataFrame] = _keep,
) -> Stage:
    """First fill of the stage layer.

    ``persist(name, df)`` is called on every new stage table as soon as it is
    computed and must return the frame to use from then on; ``WarehouseJob``
    writes the table there and returns it read back, which cuts the lineage
    before the facts are resolved against the dimensions.
    """
    counterparties, contracts, nomenclature = initial_dimensions(src, load_ts, persist)
    facts = resolve_facts(src.sales, counterparties, contracts, nomenclature)
    sales = persist("sales", initial_load(facts, facts.columns, load_ts, order_cols=FACT_ORDER))
    return Stage(counterparties, contracts, nomenclature, sales)


def initial_dimensions(
    src: Exports,
    load_ts,
    persist: Callable[[str, DataFrame], DataFrame] = _keep,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The dimension half of ``stage_initial_load``: (counterparties, contracts,
    nomenclature)."""
    def fill(name: str, columns: list[str]) -> DataFrame:
        return persist(name, initial_load(getattr(src, name), columns, load_ts))

    made = together({
        "counterparties": partial(
            fill, "counterparties", ["company", "taxpayer_identification_number", "full_name_company"]),
        "contracts": partial(fill, "contracts", ["contract", "counterparty", "company"]),
        "nomenclature": partial(fill, "nomenclature", ["nomenclature"]),
    })
    return made["counterparties"], made["contracts"], made["nomenclature"]


def stage_update(
    stage: Stage,
    src: Exports,
    load_ts,
    mode: str = "append",
    start="1900-01-01",
    end="1900-01-01",
    persist: Callable[[str, DataFrame], DataFrame] = _keep,
) -> Stage:
    """Incremental stage load (P2): dimensions first, then facts.

    Nomenclature and contracts: touch-only upsert; counterparties: type-1
    overwrite of the tax number and full name.  Each dimension then expires
    the rows this load did not see.  Facts: optional day-range replacement,
    then the resolved new facts are appended.
    """
    counterparties, contracts, nomenclature = update_dimensions(stage, src, load_ts, persist)
    facts = resolve_facts(src.sales, counterparties, contracts, nomenclature)
    sales = persist("sales", replace_range(
        stage.sales, facts, load_ts, mode=mode, start=start, end=end, order_cols=FACT_ORDER,
    ))
    return Stage(counterparties, contracts, nomenclature, sales)


def update_dimensions(
    stage: Stage,
    src: Exports,
    load_ts,
    persist: Callable[[str, DataFrame], DataFrame] = _keep,
    buckets: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The dimension half of ``stage_update``: (counterparties, contracts,
    nomenclature) after upsert and expiry.  ``buckets`` is the number of those that
    the tables of ``stage`` are stored in."""
    def renew(name: str, source: DataFrame, keys: list[str], update_cols: tuple[str, ...] = ()) -> DataFrame:
        merged = upsert(getattr(stage, name), source, keys, load_ts, update_cols=list(update_cols), tasks=buckets)
        return persist(name, expire_unseen(merged, load_ts))

    contract_keys = ["contract", "counterparty", "company"]
    made = together({
        "counterparties": partial(renew, "counterparties", src.counterparties, ["company"],
                                  ("taxpayer_identification_number", "full_name_company")),
        "contracts": partial(renew, "contracts", src.contracts.select(*contract_keys), contract_keys),
        "nomenclature": partial(renew, "nomenclature", src.nomenclature.select("nomenclature"), ["nomenclature"]),
    })
    return made["counterparties"], made["contracts"], made["nomenclature"]


# ------------------------------------------------------------------------ mart


_IDS = ["company", "counterparty", "contract", "nomenclature"]

#: Actual facts of a period and four ids: their number and sums.
SUMS_SCHEMA = ("company INT, counterparty INT, contract INT, nomenclature INT, facts BIGINT, "
               "total_quantity BIGINT, total_amount BIGINT")


def partial_sums(facts: DataFrame, *periods: Column) -> DataFrame:
    """Sums of the actual facts by period and ids (``SUMS_SCHEMA``).  A combination
    without actual facts keeps its row, so a period of facts is one of sums."""
    actual = is_true("is_actual")
    return facts.groupBy(*periods, *_IDS).agg(
        F.count_if(actual).alias("facts"),
        F.sum(F.when(actual, F.col("quantity"))).alias("total_quantity"),
        F.sum(F.when(actual, F.col("amount"))).alias("total_amount"),
    )


def report_of_sums(sums: DataFrame, counterparties: DataFrame, contracts: DataFrame,
                   nomenclature: DataFrame) -> DataFrame:
    """The mart report from partial sums: combined by ids, then named, then
    regrouped by name (exact: sums commute with the left joins)."""
    totals = {"total_quantity": "total_quantity", "total_amount": "total_amount"}
    named = sum_by(sums.where("facts > 0"), _IDS, totals)
    named = left_lookup(named, counterparties, {"company": "id"}, {"company": "company"})
    named = left_lookup(named, counterparties, {"counterparty": "id"}, {"company": "counterparty"})
    named = left_lookup(named, nomenclature, {"nomenclature": "id"}, {"nomenclature": "nomenclature"})
    # sums without a contract, which may be most, would meet in one task of its lookup
    known = left_lookup(named.where("contract IS NOT NULL"), contracts, {"contract": "id"}, {"contract": "contract"})
    none = F.lit(None).cast(known.schema["contract"].dataType)
    named = union_all([known, named.where("contract IS NULL").withColumn("contract", none).select(*known.columns)])
    return sum_by(named, _IDS, totals)


def sales_report(stage: Stage) -> DataFrame:
    """The mart report (A1): totals per company, counterparty, contract, item.

    Only actual facts count (``is_actual IS TRUE``); the dimensions' own flag
    is not consulted; NULL names group together.  Facts are summed by their
    four ids first, so names are looked up for one row a combination.
    """
    sums = partial_sums(stage.sales.where(is_true("is_actual")))
    return report_of_sums(sums, stage.counterparties, stage.contracts, stage.nomenclature)


DIMENSION_TABLES = ("nomenclature", "contracts", "counterparties")

#: Natural keys, by which dimensions are upserted and can be bucketed.
DIMENSION_KEYS = {
    "nomenclature": ["nomenclature"],
    "contracts": ["contract", "counterparty", "company"],
    "counterparties": ["company"],
}

# Columns of the landing tables that must be filled, and the
# length limits of their texts.
REQUIRED = {
    "nomenclature": ["nomenclature"],
    "contracts": ["contract", "counterparty", "company"],
    "counterparties": ["company", "full_name_company"],
    "sales": SRC_SALES_COLUMNS,
}
LIMITS = {
    "nomenclature": {"nomenclature": 250},
    "contracts": {"contract": 50, "counterparty": 100, "type_contract": 50, "currency": 25, "company": 100},
    "counterparties": {"company": 100, "taxpayer_identification_number": 12, "full_name_company": 250},
    "sales": {"company": 100, "counterparty": 100, "contract": 100, "nomenclature": 250},
}

REPORT_VIEW = "mart_sales_report"


def check_landing(src: Exports, seen: dict[str, int] | None = None) -> None:
    """Raises ConstraintViolation for a missing value or an over-long text (Q1, Q2).

    Tables in which ``land_exports`` has ``seen`` no broken rule are not read again;
    the others are, for the message.
    """
    for name, columns in REQUIRED.items():
        if seen is None or seen.get(name, 1):
            table = getattr(src, name)
            require_not_null(table, columns)
            require_length(table, LIMITS[name])


def check_references(sums: DataFrame, counterparties: DataFrame, contracts: DataFrame,
                     nomenclature: DataFrame) -> None:
    """Raises ConstraintViolation for a fact id that no dimension row has (Q4).

    The ids are taken from the partial sums, one row a combination; a missing
    name's NULL passes, as a declared foreign key lets it.  One job for all four.
    Where the ids of a dimension are found to have no gap, all between the least and
    the largest are those of rows, and only the others are looked for.
    """
    parents = {"company": counterparties, "counterparty": counterparties, "contract": contracts,
               "nomenclature": nomenclature}
    runs = together({role: partial(_run_of_ids, parents[role]) for role in _IDS[1:]})
    found = []
    for role, parent in parents.items():
        run = runs["counterparty" if role == "company" else role]
        ids = sums.where(~F.col(role).between(*run)) if run else sums
        ids = ids.select(F.lit(role).alias("role"), F.col(role).cast("long").alias("id")).distinct()
        found.append(orphans(ids, parent, ["id"]))
    require_empty(union_all(found), "fact without its dimension row")


def _run_of_ids(dim: DataFrame) -> tuple[int, int] | None:
    """The least and the largest id, if the table has all ids between them."""
    ids = dim.agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count_distinct("id").alias("n")).first()
    return (ids["first"], ids["last"]) if ids["n"] and ids["last"] - ids["first"] + 1 == ids["n"] else None


class WarehouseJob:
    """Runs the loads against tables under ``root`` (a shared folder).

    A load writes fresh folders only: ``root/src/<tag>/<table>`` for the landing
    tables, ``root/csv/<tag>/<table>`` for the cleansed exports,
    ``root/stage/<dimension>/<tag>`` and ``root/stage/sales/<tag>`` with a
    folder for each month (or day).  The last thing it writes is an entry under
    ``root/stage/loads`` that names the dimension folders, the fact folders, the
    last fact id and the load time.  Readers follow the highest entry, so they
    see all of a load or nothing, and a load that failed can be repeated with
    the same load time.  An append adds fact folders and leaves the old ones; a
    replaced range rewrites only the folders that overlap it.  Beside each fact
    folder, under ``root/stage/sums``, lie the sums of its actual facts, from which
    the report is made.

    Every stage table is written as soon as it is computed and read back, so
    fact resolution and the report scan written tables, and a lost executor
    only repeats the current step.  ``retire`` deletes the folders that no recent
    load reads.
    """

    def __init__(self, spark: SparkSession, root: str, fact_period: str = "month",
                 dimension_buckets: int | None = None, csv_compression: str | None = None):
        """``dimension_buckets`` stores new dimension folders bucketed by their natural
        keys: an upsert then exchanges the source alone, whatever the target's size.
        ``csv_compression`` is that of the cleansed CSV files, by default none."""
        self.spark = spark
        self.csv_compression = csv_compression
        self.buckets = dimension_buckets
        self.root = root.rstrip("/")
        self.periods = PeriodFolders(spark, period=fact_period)
        # load_ts, last_id, dimensions (name: folder), facts (folders), fact_schema
        self.loads = Entries(spark, f"{self.root}/stage/loads")

    def _begin(self, load_ts):
        """The current entry; expiry compares ``dt_update < load_ts``, so every
        load needs a later time than the last one that succeeded."""
        entry = self.loads.latest()
        if entry is not None:
            both = self.spark.range(1).select(
                *[F.lit(str(t)).cast("timestamp_ntz").alias(c) for c, t in
                  (("new", load_ts), ("last", entry["load_ts"]))]).first()
            if both["new"] <= both["last"]:
                raise ValueError(f"load_ts {load_ts} is not later than the previous load ({entry['load_ts']})")
        return entry

    def land(self, src: Exports, tag: str) -> Exports:
        """Landing tables and cleansed CSV files (P0), checked before anything
        is loaded from them."""
        seen: dict[str, int] = {}
        landed = land_exports(src, f"{self.root}/src/{tag}", seen)
        check_landing(landed, seen)
        together({name: partial(export_csv, getattr(landed, name), f"{self.root}/csv/{tag}/{name}",
                                compression=self.csv_compression)
                  for name in TABLES})
        return landed

    def _persist_to(self, tag: str, paths: dict[str, str], was: int | None) -> Callable[[str, DataFrame], DataFrame]:
        def persist(name: str, df: DataFrame) -> DataFrame:
            paths[name] = f"{self.root}/stage/{name}/{tag}"
            if self.buckets:
                # what an upsert into as many buckets gives is in its buckets already
                write_bucketed(df, paths[name], DIMENSION_KEYS[name], self.buckets, spread=was != self.buckets)
            else:
                df.write.parquet(paths[name])
            # read as plain files: facts would else come to the few tasks of the buckets
            return self.spark.read.schema(df.schema).parquet(paths[name])

        return persist

    def _write_facts(self, facts: DataFrame, name: str,
                     finish: Callable[[DataFrame], DataFrame] = _same) -> tuple[list[str], list[str]]:
        """New fact folders, and folders with the sums of each: only the new facts
        are read for them.  Their ids must be those of dimension rows, which is for the
        caller to check.  ``finish`` adds the columns that all of ``facts`` have alike."""
        folders = self.periods.write(facts, f"{self.root}/stage/sales/{name}", finish=finish)
        root, period = f"{self.root}/stage/sums/{name}", self.periods.period_of(F.col(self.periods.dt_col))
        written = self.periods.read(folders, finish(facts).schema)
        partial_sums(written, period.alias(self.periods.part_col)).write.partitionBy(
            self.periods.part_col).option("compression", "zstd").parquet(root)
        return folders, self.periods.folders(root)

    def _sums(self, folders: list[str]) -> DataFrame:
        return self.periods.read(folders, self.spark.createDataFrame([], SUMS_SCHEMA).schema)

    def _publish(self, tag: str, entry, load_ts, last_id: int, paths, facts, sums, schema: StructType) -> Stage:
        self.loads.publish(
            tag, entry["number"] if entry else 0, load_ts=str(load_ts), last_id=last_id,
            dimensions=paths, buckets=self.buckets, facts=facts, sums=sums, fact_schema=schema.json(),
        )
        create_report_view(self.spark, REPORT_VIEW, self.report())
        return self.stage()

    def stage(self) -> Stage:
        entry = self.loads.latest()
        if entry is None:
            raise FileNotFoundError(f"no load under {self.root}")
        dims = {name: self._dimension(entry, name) for name in DIMENSION_TABLES}
        schema = StructType.fromJson(json.loads(entry["fact_schema"]))
        return Stage(**dims, sales=self.periods.read(entry["facts"], schema))

    def _dimension(self, entry: dict, name: str) -> DataFrame:
        path, buckets = entry["dimensions"][name], entry["buckets"]
        if buckets:
            return read_bucketed(self.spark, path, DIMENSION_KEYS[name], buckets)
        return self.spark.read.parquet(path)

    def folders_in_use(self) -> list[str]:
        """Folders that the current load reads."""
        entry = self.loads.latest()
        return [*entry["dimensions"].values(), *entry["facts"], *entry["sums"]] if entry else []

    def _new_facts(self, landed: Exports, cp, ct, nm, last: int) -> tuple[DataFrame, int]:
        """Resolved facts with ids, in no order, and the last id."""
        resolve = resolve_facts if may_broadcast(cp, ct, nm) else resolve_facts_shared
        return assign_keys_unordered(resolve(landed.sales, cp, ct, nm), start=last)

    def initial_load(self, src: Exports, load_ts) -> Stage:
        entry, tag, paths = self._begin(load_ts), new_tag(), {}
        landed = self.land(src, tag)
        cp, ct, nm = initial_dimensions(landed, load_ts, self._persist_to(tag, paths, None))
        new, last = self._new_facts(landed, cp, ct, nm, 0)
        audit = partial(with_audit, load_ts=load_ts)
        facts, sums = self._write_facts(new, tag, audit)
        check_references(self._sums(sums), cp, ct, nm)
        return self._publish(tag, entry, load_ts, last, paths, facts, sums, audit(new).schema)

    def update(self, src: Exports, load_ts, mode: str = "append",
               start="1900-01-01", end="1900-01-01") -> Stage:
        """P2 with the same semantics as ``stage_update``."""
        entry, tag, paths = self._begin(load_ts), new_tag(), {}
        current = self.stage()
        landed = self.land(src, tag)
        cp, ct, nm = update_dimensions(current, landed, load_ts, self._persist_to(tag, paths, entry["buckets"]),
                                       entry["buckets"])
        new, last = self._new_facts(landed, cp, ct, nm, entry["last_id"])
        audit = partial(with_audit, load_ts=load_ts)
        facts, sums, kept_sums = entry["facts"], entry["sums"], []
        if mode == "replace":
            inside, facts = self.periods.overlapping(facts, start, end)
            _, sums = self.periods.overlapping(sums, start, end)
            if inside:
                flagged = flag_range(self.periods.read(inside, current.sales.schema), start, end)
                kept, kept_sums = self._write_facts(flagged, f"{tag}-kept")
                facts, sums = facts + kept, sums + kept_sums
        added, added_sums = self._write_facts(new, tag, audit)
        check_references(self._sums([*kept_sums, *added_sums]), cp, ct, nm)
        return self._publish(tag, entry, load_ts, last, paths, facts + added, sums + added_sums, audit(new).schema)

    def report(self) -> DataFrame:
        """The mart report, kept up to date: it reads the sums that each load left
        beside its fact folders, and no fact."""
        entry = self.loads.latest()
        if entry is None:
            raise FileNotFoundError(f"no load under {self.root}")
        sums = self._sums(entry["sums"])
        dims = (self._dimension(entry, n) for n in ("counterparties", "contracts", "nomenclature"))
        return report_of_sums(sums, *dims)

    def rejects(self) -> DataFrame:
        """``table, line`` of what the current load could not read."""
        entry = self.loads.latest()
        path = f"{self.root}/src/{entry['tag']}/rejects" if entry else ""
        if entry and list_notes(self.spark, path):
            return self.spark.read.parquet(path)
        return self.spark.createDataFrame([], "`table` STRING, line STRING")

    def retire(self, keep: int = 2) -> list[str]:
        """Delete what no one of the last ``keep`` loads reads, and return its folders:
        landing tables, exports, dimensions, facts and sums of loads before them,
        and of loads that failed.  No load may run meanwhile, and readers of older
        loads lose their files."""
        entries = self.loads.last(keep)
        if not entries:
            return []
        used = {f for e in entries for f in (*e["dimensions"].values(), *e["facts"], *e["sums"])}
        tags = {e["tag"] for e in entries}
        gone = []
        for top in ("src", "csv", *(f"stage/{n}" for n in (*DIMENSION_TABLES, "sales", "sums"))):
            for name in list_notes(self.spark, f"{self.root}/{top}"):
                folder = f"{self.root}/{top}/{name}"
                if name in tags or folder in used:
                    continue
                parts = self.periods.folders(folder) if top in ("stage/sales", "stage/sums") else []
                # of a set of periods, those that were not written anew may still be read
                gone += [p for p in parts if p not in used] if any(p in used for p in parts) else [folder]
        remove_folders(self.spark, gone)
        return gone
