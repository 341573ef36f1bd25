"""URLs, hosts and registrable domains as column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from mailtriage import constants as K
from mailtriage.functions import text as X
from mailtriage.functions.literals import among, no_strings

_LABEL = r"[a-zA-Z0-9](?:[a-zA-Z0-9\-]{0,61}[a-zA-Z0-9])?"
# possessive groups: the engine loops over them instead of recursing into them
_BODY_URL = rf"(?U)(?:https?://|www\.){_LABEL}(?:\.{_LABEL})*+(?:[/?#][^\s]*)?"
_RAW_URL = r"(?U)((?:https?://|www\.)[^\s,\)\]>\[}]+)"
_TEXT_URL = r"(?iU)https?://([^/\s,]+)"
# \G or a run start: a long run without '@' is read once, not once per position
_TEXT_ADDRESS = r"(?U)(?:\G|(?<![\w.-]))[\w.-]++@([\w.-]+\.\w+)"
_HOST = rf"^(?:{_LABEL}\.)*+{_LABEL}\z"
IPV4 = r"^\d{1,3}(?:\.\d{1,3}){3}\z"
_AUTHORITY = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)"


# --- registrable domain -----------------------------------------------------

def _any_of(words: Iterable[str]) -> str:
    """One pattern for any of the words, branching letter by letter, so that a complete
    suffix list costs a few steps per host."""
    tree: dict = {}
    for word in words:
        node = tree
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}

    def spelt(node: dict) -> str:
        arms = [re.escape(c) + spelt(below) for c, below in sorted(node.items()) if c]
        if not arms:
            return ""
        body = arms[0] if len(arms) == 1 and "" not in node else "(?:" + "|".join(arms) + ")"
        return body + ("?" if "" in node else "")

    return spelt(tree)


def registrable(host: Column, suffixes: Iterable[str] | None = None) -> Column:
    """Public suffix plus one label, else the input in lower case.

    All rules become one pattern that also skips user info, port and path.  Its prefix is
    lazy, so the longest suffix is found first, and a host costs a single match.  ``*.x``
    and ``!y.x`` rules are understood.  A complete list is read by
    :func:`mailtriage.sources.files.suffix_rules`; rules that are too many for one pattern
    belong in :func:`mailtriage.operators.domains.registrable_by_table`.
    """
    rules = list(suffixes or K.DEFAULT_SUFFIXES)
    plain = sorted(r for r in rules if not r.startswith(("!", "*.")))
    wild = sorted(r[2:] for r in rules if r.startswith("*."))
    exact = sorted(r[1:] for r in rules if r.startswith("!"))
    suffix = "|".join(p for p in (_any_of(plain), r"[^./?#:@]+\." + _any_of(wild) if wild else "") if p)

    def cut(core: str) -> str:
        return (r"(?s)^(?:[^/?#]*@)?(?:[^/?#:@]*?\.)??(" + core
                + r")\.*(?::[^/?#@]*)?(?:[/?#].*)?\z")

    low = F.lower(host)
    main = F.regexp_replace(low, cut(r"[^./?#:@]+\.(?:" + suffix + ")"), "$1")
    if not exact:
        return main
    special = cut(_any_of(exact))
    return F.when(low.rlike(special), F.regexp_replace(low, special, "$1")).otherwise(main)


def bare_host(c: Column) -> Column:
    """Drop path, query, fragment, user info, port and trailing dots."""
    c = F.regexp_replace(c, r"[/?#].*\z", "")
    c = F.regexp_replace(c, r"^.*@", "")
    return F.regexp_replace(c, r":.*\z|\.+\z", "")


# --- extraction ----------------------------------------------------------------

def raw_urls(message: Column) -> Column:
    """URLs as written in a raw message, null when there is none."""
    found = F.regexp_extract_all(message, F.lit(_RAW_URL), F.lit(1))
    return F.when(F.size(found) > 0, found)


def link_domains(body: Column, suffixes: Iterable[str] | None = None) -> Column:
    """Distinct registrable domains of the links in a body, first seen first."""
    found = F.regexp_extract_all(body, F.lit(_BODY_URL), F.lit(0))
    hosts = F.transform(found, lambda u: F.lower(F.regexp_extract(
        u, r"^(?:https?://)?([^/?#]*)", 1)))
    return F.array_distinct(F.transform(hosts, lambda h: registrable(h, suffixes)))


def body_domains(body: Column, suffixes: Iterable[str] | None = None) -> Column:
    """:func:`link_domains`, null if none."""
    domains = link_domains(body, suffixes)
    return F.when(F.size(domains) > 0, domains)


def url_cell_candidates(urls: Column) -> Column:
    """Split a URL cell on blanks and commas and strip wrapping punctuation."""
    parts = F.split(X.clean_value(urls), r"(?U)[\s,\x1c-\x1f]+")
    bare = F.transform(parts, lambda p: F.regexp_replace(
        p, r"""^[ <>()\[\]{}"']+|[ <>()\[\]{}"']+\z""", ""))
    return F.filter(bare, lambda p: p != "")


def hostname(candidate: Column) -> Column:
    """Lower-cased host of a URL, scheme optional, '' if there is none."""
    full = F.when(candidate.contains("://"), candidate).otherwise(F.concat(F.lit("https://"), candidate))
    authority = F.regexp_replace(F.regexp_extract(full, _AUTHORITY, 1), r"^.*@", "")
    return F.lower(F.regexp_replace(authority, r":.*\z", ""))


def text_domains(c: Column, suffixes: Iterable[str] | None = None) -> Column:
    """Registrable domains of links and addresses in a text, with repeats."""
    text = F.coalesce(c, F.lit(""))
    # the pattern of addresses weighs every word; few texts have an address
    addresses = F.when(F.contains(text, F.lit("@")), F.regexp_extract_all(text, F.lit(_TEXT_ADDRESS), F.lit(1))).otherwise(no_strings())
    hosts = F.concat(F.regexp_extract_all(text, F.lit(_TEXT_URL), F.lit(1)), addresses)
    return F.transform(hosts, lambda h: registrable(h, suffixes))


def safe_line_domains(line: Column, suffixes: Iterable[str] | None = None) -> Column:
    """Registrable domains of one line of comma-separated URLs."""
    hosts = F.transform(F.split(line, ","), lambda u: hostname(X.strip(u)))
    return F.transform(F.filter(hosts, lambda h: h != ""), lambda h: registrable(h, suffixes))


def base_domain(url: Column) -> Column:
    """Host cut to two labels, or three below a known second-level pair."""
    host = F.regexp_replace(url, r"(?s)^.*?://", "")
    host = F.regexp_replace(host, r"(?s)[/?#].*\z", "")
    parts = F.split(host, r"\.")
    n = F.size(parts)
    pair = (among(F.try_element_at(parts, F.lit(-2)), K.SECOND_LEVEL_LABELS)
            & among(F.try_element_at(parts, F.lit(-1)), K.SECOND_LEVEL_COUNTRIES))
    keep = F.when(F.coalesce(pair, F.lit(False)), 3).otherwise(2)
    return F.when(n > 2, F.array_join(F.slice(parts, n - keep + 1, keep), ".")).otherwise(host)


# --- validation and structure --------------------------------------------------

def prepared_host(url: Column, suffixes: Iterable[str] | None = None) -> Column:
    """struct(hostname, registrable, error); ``error`` is '' for a usable link."""
    text = X.strip(F.coalesce(url, F.lit("")))
    full = F.when(text.contains("://"), text).otherwise(F.concat(F.lit("https://"), text))
    scheme = F.lower(F.regexp_extract(full, r"^([a-zA-Z][a-zA-Z0-9+.\-]*)://", 1))
    host = hostname(full)
    clean = F.regexp_replace(host, r"\.+\z", "")
    error = (F.when(text == "", "Missing URL or domain.")
             .when(~scheme.isin("http", "https"), "Only http and https links are supported.")
             .when(host == "", "URL does not contain a valid hostname.")
             .when(~clean.rlike(_HOST), "Hostname format looks invalid.")
             .otherwise(""))
    ok = error == ""
    return F.struct(F.when(ok, clean).alias("hostname"),
                    F.when(ok, registrable(clean, suffixes)).alias("registrable"),
                    error.alias("error"))


def normalised_registrable(value: Column, suffixes: Iterable[str] | None = None) -> Column:
    return F.coalesce(prepared_host(value, suffixes)["registrable"], F.lit(""))


def structural_reason(host: Column, domain: Column) -> Column:
    """First structural warning of a host, '' when it looks ordinary."""
    digits = F.regexp_count(domain, F.lit(r"\p{Nd}"))
    letters = F.regexp_count(domain, F.lit(r"\p{L}"))
    return (F.when(host.rlike(IPV4), "Uses an IP address instead of a normal domain.")
            .when(host.startswith("xn--") | host.contains(".xn--"),
                  "Uses punycode encoding, which is often used in lookalike domains.")
            .when(F.regexp_count(host, F.lit("-")) >= 4, "Uses an unusually hyphenated domain name.")
            .when((digits >= 4) & (digits > letters),
                  "Uses unusually heavy digit patterns in the domain.")
            .otherwise(""))


def _suffix_tail(suffixes: Iterable[str] | None) -> str:
    rules = [r for r in (suffixes or K.DEFAULT_SUFFIXES) if not r.startswith("!")]
    wild = [r[2:] for r in rules if r.startswith("*.")]
    return "|".join(p for p in (_any_of(r for r in rules if not r.startswith("*.")), r"[^.]+\." + _any_of(wild) if wild else "") if p)


def brand_label(domain: Column, suffixes: Iterable[str] | None = None) -> Column:
    """First label of a registrable domain, null when no public suffix matches."""
    name = registrable(domain, suffixes)
    return F.when(name.rlike(rf"^[^.]+\.(?:{_suffix_tail(suffixes)})\z"), F.substring_index(name, ".", 1))


def domain_label(domain: Column, suffixes: Iterable[str] | None = None) -> Column:
    """Like :func:`brand_label`, but a host without a public suffix gives its last label
    (an IPv4 address stays whole)."""
    name = F.lower(domain)
    last = F.when(name.rlike(IPV4), name).otherwise(F.substring_index(name, ".", -1))
    return F.coalesce(brand_label(domain, suffixes), last)


def label_tokens(label: Column) -> Column:
    """Alphanumeric pieces of a domain label; the label itself when nothing is left."""
    pieces = F.filter(F.split(label, r"[^a-z0-9]+"), lambda t: t != "")
    return F.when(F.size(pieces) > 0, pieces).otherwise(F.array(label))
