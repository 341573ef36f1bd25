"""Text cleaning as column expressions (no Python workers).

Patterns use Java's ``(?U)`` flag where Unicode classes are meant; without it
``\\s``, ``\\w`` and ``\\b`` know ASCII only.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F

from mailtriage import constants as K
from mailtriage.functions.literals import among, no_strings

# white space as a text user sees it, with the four ASCII separators Java leaves out
_SPACE = r"[\s\x1c-\x1f]"
_SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(
    map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# named entities handled without a parser; &amp; goes last so that it is decoded once
_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ",
    "&copy;": "©", "&reg;": "®", "&euro;": "€", "&pound;": "£",
    "&yen;": "¥", "&hellip;": "…", "&mdash;": "—", "&ndash;": "–",
    "&lsquo;": "‘", "&rsquo;": "’", "&ldquo;": "“", "&rdquo;": "”",
    "&trade;": "™", "&bull;": "•", "&amp;": "&",
}
_TAG_MARK = "\u0001"
HEADER_LINE = (
    r"(?i)^[\s\x1c-\x1f]*(?:" + "|".join(K.BODY_HEADER_NAMES) + r"|x-[\w-]+)[\s\x1c-\x1f]*:"
)


def strip(c: Column) -> Column:
    """Trim every kind of white space (Spark's ``trim`` removes blanks only)."""
    return F.btrim(c, F.lit(_SPACES))


def collapse_spaces(c: Column, by: str = " ") -> Column:
    return F.regexp_replace(c, rf"(?U){_SPACE}+", by)


def clean_value(c: Column) -> Column:
    """Trim; null and placeholder words such as ``nan`` become the empty string."""
    trimmed = strip(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(among(F.lower(trimmed), K.PLACEHOLDER_VALUES), "").otherwise(trimmed)


def fill_text(df, columns: Iterable[str]):
    """Make every named column a non-null string; absent ones become ``''``."""
    return df.withColumns({
        c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in df.columns else F.lit("")
        for c in columns
    })


def clean_corpus_text(c: Column, keep_tags: bool = False) -> Column:
    """Drop ``<...>``, separator runs, square brackets and quotes; collapse spaces."""
    text = c.cast("string")
    if not keep_tags:
        text = F.regexp_replace(text, r"<[^>]*>", "")
    text = F.regexp_replace(text, r"[-*]{4,}", " ")
    text = F.regexp_replace(text, r"""[\[\]'"]+""", "")
    return strip(collapse_spaces(text))


def normalise(c: Column) -> Column:
    """Lower case, single blanks, trimmed; null counts as empty."""
    return strip(collapse_spaces(F.lower(F.coalesce(c.cast("string"), F.lit("")))))


def strip_html(c: Column) -> Column:
    """Replace script/style blocks and tags by a blank and collapse spaces."""
    text = F.regexp_replace(c, r"(?is)<(script|style).*?>.*?</\1>", " ")
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    return strip(collapse_spaces(text))


def unescape_entities(c: Column) -> Column:
    """Decode numeric references and the common named entities."""
    def decode(piece: Column) -> Column:
        ref = F.lower(F.substring_index(piece, ";", 1))
        code = (
            F.when(ref.startswith("x"), F.conv(F.substring(ref, 2, 6), 16, 10))
            .otherwise(ref)
            .try_cast("long")
        )
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        rest = F.regexp_replace(piece, r"^[^;]*;", "")
        return F.concat(F.when(valid, char).otherwise("\ufffd"), rest)

    decoded = _let(F.split(c, r"&#(?=[0-9]{1,7};|[xX][0-9a-fA-F]{1,6};)"), lambda pieces: F.concat(
        F.element_at(pieces, 1), F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), decode), "")))
    for name, char in _ENTITIES.items():
        decoded = F.replace(decoded, F.lit(name), F.lit(char))
    return decoded


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that it names several times and that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _upto_last(c: Column, end: str) -> Column:
    """The text up to and with the last ``end``: behind it no tag can close, so nothing there is worth a search."""
    return F.substring(c, F.lit(1), F.length(c) - F.length(F.substring_index(c, end, -1)))


def _without_blocks(c: Column, name: str) -> Column:
    """Replace ``<name ...> ... </name>`` by the mark.

    The text is cut at the closing tags, so an opening tag is looked for once per closing one, and an unclosed one
    costs no search to the end of the text.
    """
    opening, closing = rf"(?is)<{name}\b[^>]*+>.*", rf"(?i)</{name}\s*+>"

    def kept(piece: Column) -> Column:
        # a closing tag by itself is a tag like any other
        return _let(_upto_last(piece, ">"), lambda head: _let(F.regexp_replace(head, opening, _TAG_MARK), lambda cut: F.when(
            cut != head, cut).otherwise(F.concat(piece, F.lit(f"</{name}>")))))

    return _let(F.split(c, closing), lambda pieces: F.concat(
        F.array_join(F.transform(F.slice(pieces, 1, F.size(pieces) - 1), kept), ""), F.element_at(pieces, -1)))


def _without_comments(c: Column) -> Column:
    def kept(piece: Column) -> Column:
        return F.when(piece.contains("<!--"), F.concat(F.substring_index(piece, "<!--", 1), F.lit(_TAG_MARK))).otherwise(
            F.concat(piece, F.lit("-->")))

    return _let(F.split(c, "-->"), lambda pieces: F.concat(
        F.array_join(F.transform(F.slice(pieces, 1, F.size(pieces) - 1), kept), ""), F.element_at(pieces, -1)))


def _without_tags(c: Column) -> Column:
    return _let(c, lambda text: _let(_upto_last(text, ">"), lambda head: F.concat(
        F.regexp_replace(head, r"</?[a-zA-Z][^>]*+>|<[!?][^>]*+>", _TAG_MARK), F.substr(text, F.length(head) + 1))))


def html_to_text(c: Column) -> Column:
    """Text of an HTML page, one line per text node.

    Script-like blocks, comments and tags all turn into one mark character; a run of marks is one line break.  Time
    grows with the length of the text, closed or not: every search starts where its end is known to exist.  Blocks go
    name by name, so of blocks that overlap without nesting the first name of the list wins.
    """
    text = c
    for name in ("script", "style", "noscript", "iframe"):
        text = _without_blocks(text, name)
    text = _without_tags(_without_comments(text))
    text = F.regexp_replace(text, _TAG_MARK + "++", "\n")
    # entities are decoded by the parser and once more afterwards
    text = unify_newlines(unescape_entities(unescape_entities(text)))
    space = r"[\s\x1c-\x1f&&[^\n]]"
    return strip(F.regexp_replace(text, rf"(?U)(?<!{space}){space}++(?=\n)", ""))


def unify_newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"\r\n?", "\n")


def drop_header_lines(c: Column) -> Column:
    """Remove header-like lines that leaked into a body."""
    lines = F.split(unify_newlines(F.coalesce(c, F.lit(""))), "\n")
    return strip(F.array_join(F.filter(lines, lambda x: ~x.rlike(HEADER_LINE)), "\n"))


def split_header_body(c: Column) -> Column:
    """struct(header, body) cut at the first blank line; no blank line: all is body."""
    text = unify_newlines(F.coalesce(c, F.lit("")))
    parts = F.split(text, "\n\n", 2)
    found = F.size(parts) == 2
    return F.struct(
        F.when(found, parts[0]).otherwise("").alias("header"),
        F.when(found, parts[1]).otherwise(text).alias("body"),
    )


def combined_text(subject: Column, body: Column, sender: Column, urls: Column) -> Column:
    parts = zip(("subject", "body", "sender", "urls"), (subject, body, sender, urls))
    return strip(F.concat_ws(" ", *[F.concat(F.lit(name + " "), clean_value(c)) for name, c in parts]))


# --- keywords ---------------------------------------------------------------

def keyword_tokens(c: Column) -> Column:
    """Letter, then two or more of letter, apostrophe, hyphen; lower; no outer quote."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"[A-Za-z][A-Za-z'-]{2,}"), F.lit(0))
    return F.transform(found, lambda t: F.regexp_replace(F.lower(t), r"^'+|'+\z", ""))


def candidate_keywords(c: Column, stop_words: Iterable[str] | None = None) -> Column:
    """Distinct tokens in first-seen order, without stop words and words in -ly."""
    stops = list(stop_words or K.COMMON_WORDS + K.POSITIVE_WORDS + K.WEAK_SIGNAL_WORDS)
    kept = F.filter(keyword_tokens(c), lambda t: ~t.endswith("ly") & ~among(t, stops))
    return F.array_distinct(kept)


def one_of(terms: Iterable[str]) -> str:
    """Alternation of literal terms, grouped by first letter and longest first, so that a
    position of the text is compared with few terms."""
    by_letter: dict[str, list[str]] = {}
    for term in sorted(set(terms), key=lambda t: (-len(t), t)):
        by_letter.setdefault(term[0], []).append(term[1:])
    return "|".join(
        re.escape(letter) + "(?:" + "|".join(map(re.escape, tails)) + ")"
        for letter, tails in sorted(by_letter.items()))


def term_pattern(terms: Iterable[str]) -> str:
    """Whole-word alternation; group 1 is the term."""
    return rf"(?U)\b({one_of(terms)})\b"


def non_overlapping_groups(terms: Iterable[str]) -> list[list[str]]:
    """Split terms so that no two in a group can share words of the text.

    Inside one group a single alternation counts every term exactly; terms such as
    "password reset" and "reset your password" must be searched separately.
    """
    def clash(a: str, b: str) -> bool:
        x, y = a.split(), b.split()
        touch = any(x[-n:] == y[:n] or y[-n:] == x[:n] for n in range(1, min(len(x), len(y)) + 1))
        return touch or f" {a} " in f" {b} " or f" {b} " in f" {a} "

    groups: list[list[str]] = []
    for term in terms:
        for group in groups:
            if not any(clash(term, other) for other in group):
                group.append(term)
                break
        else:
            groups.append([term])
    return groups


def term_hits(text: Column, terms: Iterable[str]) -> Column:
    """Every whole-word occurrence of the terms in a lower-cased text, with repeats."""
    found = [
        F.regexp_extract_all(text, F.lit(term_pattern(group)), F.lit(1))
        for group in non_overlapping_groups(terms)
    ]
    return found[0] if len(found) == 1 else F.concat(*found)


def term_pieces(text: Column, terms: Iterable[str]) -> Column:
    """What lies between blanks in a lower-cased text and may hold one of the terms, joined by blanks.

    A piece of the letters a to z alone holds a term only if it is one.  No match for a term
    without blanks crosses a blank, so :func:`term_hits` and :func:`token_terms` find the
    same in the pieces as in the text, in the same order, and read a fraction of it.
    """
    terms = list(terms)
    if not terms or any(" " in t for t in terms):
        return text
    held, shortest = rf"(?<![a-z])(?:{one_of(terms)})(?![a-z])", min(map(len, terms))
    return F.array_join(F.filter(F.split(text, " "), lambda w: (F.length(w) >= shortest) & (
        (w.rlike("[^a-z]") & w.rlike(held)) | w.isin(terms))), " ")


def phrase_count(text: Column, phrase: str) -> Column:
    """How often a phrase occurs in a lower-cased text, with any white space for its blanks.

    The pattern begins with the letters of the first word, which the engine finds by leaps.
    """
    first, *others = map(re.escape, phrase.split(" "))
    return F.regexp_count(text, F.lit(rf"(?U){first}(?<=\b{first})" + "".join(f"{_SPACE}+{w}" for w in others) + r"\b"))


def count_term(text: Column, term: str | Column) -> Column:
    """Whole-word, case-insensitive count; the term may come from a column."""
    if isinstance(term, Column):
        pattern = F.concat(F.lit(r"(?iU)\b\Q"), term, F.lit(r"\E\b"))
    else:
        pattern = F.lit(rf"(?iU)\b{re.escape(term)}\b")
    return F.coalesce(F.regexp_count(text, pattern), F.lit(0))


def highlight(c: Column, keywords: Column) -> Column:
    """Wrap whole-word keywords, longest first, in one pass with a per-row pattern."""
    ordered = F.array_sort(F.transform(keywords, lambda k: F.struct((-F.length(k)).alias("n"), k.alias("k"))))
    body = F.array_join(F.transform(ordered, lambda s: F.concat(F.lit("\\Q"), s["k"], F.lit("\\E"))), "|")
    pattern = F.concat(F.lit(r"(?iU)\b("), body, F.lit(r")\b"))
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(F.size(keywords) == 0, text).otherwise(
        F.regexp_replace(text, pattern, F.lit(K.HIGHLIGHT_OPEN + "$1" + K.HIGHLIGHT_CLOSE)))


def token_terms(text: Column, terms: Iterable[str]) -> Column:
    """Keyword tokens of a lower-cased text that equal one of the terms, in text order.

    Same result as filtering :func:`keyword_tokens`, in one pass: a token is a whole run of
    letters, apostrophes and hyphens without leading marks and outer apostrophes.
    """
    pattern = rf"(?<![a-z'-])['-]*({one_of(terms)})'*(?![a-z'-])"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def ordered_matches(tokens: Column, matched: Column) -> Column:
    """Matched words by first position among the tokens, then the rest alphabetically."""
    seen = F.array_distinct(F.filter(tokens, lambda t: F.array_contains(matched, t)))
    return F.concat(seen, F.array_sort(F.array_except(matched, seen)))


def clean_keywords(words: Column) -> Column:
    """Trim, lower, keep 3 to 30 letters or hyphens, no http/www; sorted distinct."""
    low = F.transform(words, lambda w: F.lower(strip(w)))
    kept = F.filter(low, lambda w: F.length(w).between(3, 30)
                    & ~w.contains("http") & ~w.contains("www") & w.rlike(r"^[a-zA-Z][a-zA-Z-]*\z"))
    return F.array_sort(F.array_distinct(kept))


def has_non_ascii(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"[^\x00-\x7F]")


def first_seen(items: Column) -> Column:
    """Distinct non-empty items in first-seen order."""
    return F.array_distinct(F.filter(items, lambda x: x.isNotNull() & (x != "")))


def plain_part(raw: Column, default: Column) -> Column:
    """Body of a mail that no MIME parser could read: text/plain part, else what follows
    the first blank line; soft line breaks and ``=3D`` undone in the first case."""
    part = r"(?is)Content-Type:\s*text/plain.*?\r?\n\r?\n(.*?)(?=\r?\n--|\z)"
    text = F.regexp_extract(raw, part, 1)
    text = F.replace(F.replace(text, F.lit("=\r\n"), F.lit("")), F.lit("=3D"), F.lit("="))
    blocks = F.split(raw, r"\r?\n\r?\n")
    after = F.array_join(F.slice(blocks, 2, F.greatest(F.size(blocks), F.lit(1))), "\n\n")
    return (F.when(raw.rlike(part), strip(text))
            .when(F.size(blocks) > 1, strip(after)).otherwise(default))
