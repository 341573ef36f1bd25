"""Header fields, addresses and sender hosts as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from mailtriage import constants as K
from mailtriage.functions import text as X

# a line that may stand in a header block: a field, a continuation or an mbox line
_FIELD_LINE = r"^(?:From |[!-9;-~]*:|[\t ])"
_ADDRESS = r"(?i)[A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,}"
_ANGLE_ADDRESS = r"(?U)<\s*([^<>@\s]+@[^<>@\s]+)\s*>"


def column_name(field: str) -> str:
    """``List-Id`` -> ``list_id``."""
    return field.lower().replace("-", "_")


def split_message(raw: Column) -> Column:
    """struct(header, body) of a raw message.

    The header block ends at the first blank line or at the first line that cannot be a
    header.  Only the part before the first blank line is split into lines.
    """
    text = X.unify_newlines(F.coalesce(raw, F.lit("")))
    head = F.substring_index(text, "\n\n", 1)
    has_blank = F.length(head) < F.length(text)
    rest = F.when(has_blank, F.substr(text, F.length(head) + 3)).otherwise("")
    lines = F.split(head, "\n")
    stop = F.array_position(F.transform(lines, lambda x: x.rlike(_FIELD_LINE)), False)
    n_head = F.when(stop == 0, F.size(lines)).otherwise(stop - 1).cast("int")
    left = F.slice(lines, n_head + 1, F.size(lines))
    # a blank first line only closes the (empty) block and is not part of the body
    left = F.when(F.element_at(lines, n_head + 1) == "", F.slice(left, 2, F.size(lines))).otherwise(left)
    body = F.when(stop == 0, rest).otherwise(
        F.concat(F.array_join(left, "\n"), F.when(has_blank, F.concat(F.lit("\n\n"), rest)).otherwise("")))
    return F.struct(F.array_join(F.slice(lines, 1, n_head), "\n").alias("header"), body.alias("body"))


def _quoted_printable(c: Column) -> Column:
    """Soft line breaks undone, ``=XX`` as UTF-8 bytes; text that is no valid encoding stays."""
    joined = F.regexp_replace(c, r"=[ \t]*\n", "")
    spelt = F.regexp_replace(F.replace(F.replace(joined, F.lit("%"), F.lit("%25")), F.lit("+"), F.lit("%2B")),
                             "=([0-9A-Fa-f]{2})", "%$1")
    return F.coalesce(F.try_url_decode(spelt), joined)


def _part_text(part: Column) -> Column:
    """Decoded content of one MIME part, null if it is no text or an attachment."""
    head = F.substring_index(part, "\n\n", 1)
    content = F.substr(part, F.length(head) + 3)
    kind = F.lower(F.regexp_extract(head, r"(?im)^content-type:\s*([^;\s]+)", 1))
    encoding = F.lower(F.regexp_extract(head, r"(?im)^content-transfer-encoding:\s*(\S+)", 1))
    plain = (F.when(encoding == "base64", F.coalesce(
        F.decode(F.try_to_binary(F.regexp_replace(content, r"\s", ""), F.lit("base64")), "UTF-8"), content))
        .when(encoding == "quoted-printable", _quoted_printable(content)).otherwise(content))
    attached = head.rlike(r"(?im)^content-disposition:\s*attachment")
    return F.when(((kind == "") | kind.startswith("text/")) & ~attached, plain)


def payload(message: Column) -> Column:
    """Body of a split message: the text parts of a multipart mail, decoded and joined by
    blank lines; any other body as it is.  Parts inside parts are cut at their own marks."""
    header, body = message["header"], message["body"]
    kind = header_value(header, "Content-Type")
    marks = F.array_distinct(F.regexp_extract_all(
        F.concat(header, F.lit("\n"), body), F.lit(r"(?im)^content-type:\s*multipart/[^;\n]*;(?:[^\n]|\n[ \t])*?boundary=\"?([^\";\s]+)"), F.lit(1)))
    pattern = F.concat(F.lit("\n--(?:"), F.array_join(F.transform(marks, lambda b: F.concat(F.lit("\\Q"), b, F.lit("\\E"))), "|"),
                       F.lit(")(?:--)?[ \t]*(?=\n|\\z)"))
    parts = F.split(F.concat(F.lit("\n"), body), pattern)
    texts = F.array_compact(F.transform(F.slice(parts, 2, F.size(parts)), lambda p: _part_text(F.regexp_replace(p, r"\A\n", ""))))
    texts = F.filter(texts, lambda t: X.strip(t) != "")
    return F.when(F.lower(kind).startswith("multipart/") & (F.size(marks) > 0), F.array_join(texts, "\n\n")).otherwise(body)


def header_value(header: Column, field: str) -> Column:
    """First value of a field, folded lines kept as they are; null when absent."""
    pattern = rf"(?im)^{field}:[ \t]*(.*(?:\n[ \t].*)*+)"
    return F.when(header.rlike(rf"(?im)^{field}:"), F.regexp_extract(header, pattern, 1))


def parse_headers(df: DataFrame, message: str = "message",
                  fields: Iterable[str] | None = None) -> DataFrame:
    """Append one column per header field plus ``body`` (see :func:`payload`) beside the originals."""
    fields = list(fields or K.HEADER_FIELDS)
    staged = df.withColumn("_m", split_message(F.col(message)))
    return staged.withColumns(
        {column_name(f): header_value(F.col("_m.header"), f) for f in fields}
        | {"body": payload(F.col("_m"))}
    ).drop("_m")


def header_pairs(header: Column) -> Column:
    """array<struct<name, value>> of all fields in order, folds kept."""
    marked = F.regexp_replace(header, r"\n(?![ \t])", "\u0001")
    rows = F.filter(F.split(marked, "\u0001"), lambda x: x.rlike(r"^[!-9;-~]+:"))
    return F.transform(rows, lambda x: F.struct(
        F.substring_index(x, ":", 1).alias("name"),
        F.regexp_replace(F.substr(x, F.length(F.substring_index(x, ":", 1)) + 2), r"^[ \t]+", "").alias("value")))


def header_map(block: Column) -> Column:
    """map of known header names to unfolded values; the last value of a name wins."""
    lines = F.split(block, "\n")
    kept = F.filter(lines, lambda x: x.rlike(X.HEADER_LINE) | x.rlike(r"^[ \t]"))
    # glue continuation lines to their field, then read name and value off each piece
    glued = F.array_join(
        F.transform(kept, lambda x: F.when(x.rlike(X.HEADER_LINE), F.concat(F.lit("\u0001"), x))
                    .otherwise(F.concat(F.lit(" "), X.strip(x)))), "")
    pieces = F.filter(F.split(glued, "\u0001"), lambda x: x.rlike(X.HEADER_LINE))
    entry = F.transform(pieces, lambda x: F.struct(
        F.lower(X.strip(F.substring_index(x, ":", 1))).alias("k"),
        X.strip(F.regexp_replace(F.substr(x, F.length(F.substring_index(x, ":", 1)) + 2),
                                 r"(?U)^\s+", "")).alias("v")))
    # keep the last entry of every name: reverse, then first per name
    names = F.array_distinct(F.transform(entry, lambda e: e["k"]))
    last = F.reverse(entry)
    return F.map_from_entries(F.transform(names, lambda k: F.struct(
        k.alias("k"), F.element_at(F.filter(last, lambda e: e["k"] == k), 1)["v"].alias("v"))))


def is_blank(c: Column) -> Column:
    return c.isNull() | (X.strip(c) == "")


def normalise_addresses(c: Column) -> Column:
    """Addresses in angle brackets, else any address, else the cleaned text."""
    angles = F.regexp_extract_all(c, F.lit(_ANGLE_ADDRESS), F.lit(1))
    plain = F.regexp_extract_all(c, F.lit(_ADDRESS), F.lit(0))
    return (F.when(F.size(angles) > 0, F.array_join(angles, ", "))
            .when(F.size(plain) > 0, F.array_join(plain, ", "))
            .otherwise(X.clean_corpus_text(c)))


# --- the three sender-host rules ---------------------------------------------

def mailbox_host(c: Column) -> Column:
    """Host of the first mailbox (``Name <user@host>`` or ``user@host``), '' if none."""
    text = F.coalesce(c, F.lit(""))
    inner = F.regexp_extract(text, r"<([^<>]*)>", 1)
    address = F.when(inner != "", inner).otherwise(F.regexp_replace(text, r"\([^()]*\)|[,;].*", ""))
    host = F.regexp_replace(F.lower(X.strip(F.regexp_extract(address, r"(?s)@(.*)", 1))), r"^>+|>+\z", "")
    return host


def text_host(c: Column) -> Column:
    """Lower-cased host of the first address inside free text, null if none."""
    host = F.regexp_extract(c, r"(?U)[\w.-]+@([\w.-]+\.\w+)", 1)
    return F.lower(F.nullif(host, F.lit("")))


def feature_host(c: Column) -> Column:
    """What follows the first ``@`` up to a blank or ``>``, '' if none."""
    return F.lower(F.regexp_extract(X.clean_value(c), r"(?U)@([^\s>]+)", 1))


def pick_sender(df: DataFrame) -> Column:
    """``sender_email`` unless empty, else ``from``, else ''."""
    options = [F.nullif(F.col(f"`{c}`"), F.lit("")) for c in ("sender_email", "from") if c in df.columns]
    return F.coalesce(*options, F.lit(""))
