"""Bronze layer: delimited text messages to typed rows, with a quarantine for what does not parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.schemas import DISPATCH_MESSAGE

CORRUPT = "_corrupt_record"


def parse_messages(df: DataFrame, schema: T.StructType = DISPATCH_MESSAGE, value: str = "value") -> DataFrame:
    """One row per CSV message: the schema's fields plus ``_corrupt_record`` (NULL when the line parsed cleanly).

    Fields that do not parse are NULL, missing trailing fields are NULL and extra fields are dropped. Works on batch and
    streaming input; other input columns are kept.
    """
    target = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    text = F.col(value).cast("string")
    parsed = F.from_csv(text, ddl(target), _csv_options())
    kept = [c for c in df.columns if c != value]
    return df.select(*kept, parsed.alias("data"), text.alias("__text")).select(
        *kept,
        *[F.col("data")[f.name].alias(f.name) for f in schema],
        # An empty line gives an all-NULL row without being flagged, so it is flagged here.
        F.when(F.length(F.trim("__text")) == 0, F.col("__text"))
        .otherwise(F.col("data")[CORRUPT])
        .alias(CORRUPT),
    )


def ddl(schema: T.StructType) -> str:
    """Column definitions of a schema; names are quoted, whatever is in them."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


def _csv_options() -> dict[str, str]:
    return {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def derive_columns(df: DataFrame, ts: str = "trading_interval", ingested_at: Column | None = None) -> DataFrame:
    """Add the partition date and the processing time."""
    return df.withColumns(
        {
            "trading_date": F.to_date(ts),
            "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
        }
    )


def is_quarantined(required: tuple[str, ...] = ("trading_interval", "unit_id")) -> Column:
    """Rows that must not reach the table: text that did not parse, or a missing key field."""
    bad = F.col(CORRUPT).isNotNull()
    for name in required:
        bad = bad | F.col(name).isNull()
    return bad


def parse_dispatch(
    df: DataFrame,
    schema: T.StructType = DISPATCH_MESSAGE,
    value: str = "value",
    quarantine: bool = False,
    required: tuple[str, ...] = ("trading_interval", "unit_id"),
) -> tuple[DataFrame, DataFrame | None]:
    """``(good, bad)``. Without ``quarantine`` every message is kept in ``good`` and ``bad`` is None."""
    parsed = parse_messages(df, schema, value)
    if not quarantine:
        return derive_columns(parsed.drop(CORRUPT)), None
    good = derive_columns(parsed.where(~is_quarantined(required)).drop(CORRUPT))
    return good, parsed.where(is_quarantined(required))
