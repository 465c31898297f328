"""Shape Silver and Gold into warehouse tables and publish them per day."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail import contract as c
from paytrail.functions.money import cents


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(name.upper() for name in df.columns))


def rename_present(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the columns that exist; ignore the rest of the mapping."""
    return df.withColumnsRenamed(mapping)


def keep_present(df: DataFrame, names) -> DataFrame:
    """Project to the named columns that exist, in the given order."""
    return df.select(*(name for name in names if name in df.columns))


def _key(*parts: Column) -> Column:
    """MD5 of the parts joined by dashes; a missing part counts as empty text."""
    texts = (F.coalesce(part.cast("string"), F.lit("")) for part in parts)
    return F.md5(F.concat_ws("-", *texts))


def _amount_text() -> Column:
    """Two decimals for whole cents, else the shortest text of the double."""
    amount = F.col("amount")
    fixed = F.when(cents(amount).isNotNull(), amount.try_cast("decimal(18,2)")).cast("string")
    return F.coalesce(fixed, amount.cast("string"))


# Table -> (id column, parts of the id in order).
TABLE_IDS = {
    "fact_transactions": (
        "transaction_id",
        lambda: _key(F.col("name_orig"), F.col("step"), _amount_text(), F.col("name_dest")),
    ),
    "fraud_alerts": (
        "alert_id",
        lambda: _key(F.lit("alert"), F.col("name_orig"), F.col("step"), _amount_text()),
    ),
    "transaction_summary": (
        "summary_id",
        lambda: _key(F.lit("summary"), F.col("name_orig"), F.col("transaction_date")),
    ),
}


def shape(df: DataFrame, table: str, loaded_at: Column) -> DataFrame:
    """Rows of a warehouse table: its names, its id, its columns, the load stamp."""
    id_name, id_value = TABLE_IDS[table]
    named = rename_present(df, c.WAREHOUSE_NAMES)
    stamped = named.withColumns({id_name: id_value(), "loaded_at": loaded_at})
    return keep_present(stamped, c.WAREHOUSE_TABLES[table][0].names)


def load_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, as ``(table_name, rows_loaded)``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows_loaded"))
        .select(F.lit(name).alias("table_name"), "rows_loaded")
        for name, df in tables.items()
    ]
    report = counts[0]
    for part in counts[1:]:
        report = report.unionByName(part)
    return report
