"""Typed schemas of the tables that jobs read and write."""

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CLEAN_MAIL = T.StructType(
    [T.StructField(c, _S) for c in
     ("message_id", "date", "from", "to", "subject", "sender", "list_id", "body", "urls")]
    + [T.StructField("num_urls", _I), T.StructField("label", _I)]
)

REPUTATION = _struct(
    domain=_S, legitimacy_score=_I, total_occurrences=_L, in_spam=_L, in_ham=_L,
    sources=_S, category=_S,
)

# one mail to score; every key is optional
MAIL_REQUEST = T.StructType(
    [T.StructField(c, _S) for c in
     ("id", "sender_email", "from", "subject", "body", "url", "urls")]
)


def missing_columns(df, required) -> list[str]:
    """Sorted names of required columns that a frame lacks (known at plan time)."""
    return sorted(set(required) - set(df.columns))


def require_columns(df, required, what="Training dataset") -> None:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{what} is missing required columns: " + ", ".join(missing))
