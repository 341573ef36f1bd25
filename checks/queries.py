"""Registered queries: each a Spark job over the given tables and, where SQL can say the
same, an oracle.  Nested results are flattened to text so that values can be compared."""

from __future__ import annotations

import hashlib

from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from checks import sql as Q
from mailtriage import constants as K
from mailtriage.functions import features as FE, headers as H, text as X, urls as U
from mailtriage.operators import (domains as D, explain as EX, lexicon as LX, links as LK, lookalike as LA, lookup as LU,
                                  metrics as M, ngrams as NG, ordering as O, quality as QA, scoring as S, sender as SE, tfidf as T)
from mailtriage.plans import corpus as PC, score as PS, train as TR
from mailtriage.session import staging_dir
from checks import corpus as C
from mailtriage.sources import files as FS, sinks as SK

SUF = C.CORPUS_SUFFIXES
REGISTRY: dict[str, tuple] = {}


def query(oracle=None, name=None):
    def add(fn):
        REGISTRY[name or fn.__name__] = (fn, oracle)
        return fn
    return add


def bars(c):
    """array<string> as text; null stays null."""
    return F.array_join(c, "|")


def _mails(spark, sf):
    return C.emails(spark, sf)


def _raw(spark, sf):
    return C.raw_messages(C.emails(spark, sf))


def _scratch(spark, name):
    import uuid
    return f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _page_hosts(spark, sf):
    host = F.regexp_replace(U.hostname(F.col("url")), r"^(www|m|blog)[.]", "")
    return C.table(spark, sf, "pages").select(host.alias("host")).distinct()


def E(final, *more):
    return Q.ctes(Q.EMAILS, *more, final=final)


# --- counts, profiles, deduplication ---------------------------------------------------

@query(E("SELECT count(*) AS n_rows FROM raw", Q.RAW))
def corpus_row_count(spark, sf):
    return QA.row_count(_raw(spark, sf))


@query(E("SELECT label, count(*) AS n FROM emails GROUP BY label"))
def label_distribution(spark, sf):
    return QA.label_counts(_mails(spark, sf))


_COLS = ["email_id", "subject", "body", "from", "to", "urls", "label", "lang"]


@query(E(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) FILTER ("{c}" IS NULL) AS n_null FROM emails""" for c in _COLS)))
def null_counts(spark, sf):
    return QA.null_counts(_mails(spark, sf))


_TYPES = {"email_id": "bigint", "label": "int"}


@query(E(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{_TYPES.get(c, "string")}' AS data_type, count("{c}") AS non_null,
        count(*) AS n_rows FROM emails""" for c in _COLS)))
def frame_profile(spark, sf):
    return QA.profile(_mails(spark, sf))


@query(E("""SELECT min(email_id) AS email_id, first(label ORDER BY email_id) AS label, message
            FROM raw GROUP BY message""", Q.RAW))
def distinct_messages(spark, sf):
    return QA.drop_duplicate_messages(_raw(spark, sf))


@query(E("SELECT count(*) AS n_before, count(DISTINCT message) AS n_after FROM raw", Q.RAW))
def duplicate_report(spark, sf):
    return QA.duplicate_report(_raw(spark, sf))


@query(E("SELECT DISTINCT label, message FROM raw", Q.RAW))
def distinct_rows(spark, sf):
    return QA.drop_duplicate_rows(_raw(spark, sf).select("label", "message"))


@query(E("SELECT email_id FROM raw WHERE email_id % 19 = 0", Q.RAW))
def empty_messages(spark, sf):
    # every nineteenth message is emptied, as files of no length would be
    m = _raw(spark, sf).withColumn("message", F.when(F.col("email_id") % 19 == 0, "").otherwise(F.col("message")))
    return QA.empty_messages(m).select("email_id")


@query(E(r"SELECT email_id FROM raw WHERE regexp_matches(message, '[^\x00-\x7F]')", Q.RAW))
def non_ascii_messages(spark, sf):
    return QA.non_ascii_rows(_raw(spark, sf)).select("email_id")


@query(E("""SELECT email_id, message, CASE WHEN r = 1 THEN 'first' WHEN r = n THEN 'last' ELSE 'middle' END AS place
            FROM (SELECT *, row_number() OVER (ORDER BY email_id) AS r, count(*) OVER () AS n FROM raw)
            WHERE r IN (1, n // 2 + 1, n)""", Q.RAW))
def corpus_ends(spark, sf):
    return O.first_middle_last(_raw(spark, sf).select("email_id", "message"), "email_id").select(
        "email_id", "message", "place")


@query(E("SELECT email_id, label, message FROM raw ORDER BY email_id LIMIT 5", Q.RAW))
def corpus_head(spark, sf):
    return O.head(_raw(spark, sf), "email_id")


@query(E("SELECT email_id, body FROM emails ORDER BY md5(email_id || ':42'), email_id LIMIT 3"))
def random_mails(spark, sf):
    return O.random_rows(_mails(spark, sf).select("email_id", "body"), "email_id")


# --- headers and bodies ----------------------------------------------------------------

_PARSED = """cut AS (SELECT *, instr(message, chr(10) || chr(10)) AS cut_at FROM raw),
parsed AS (SELECT email_id, label, message, substr(message, 1, cut_at - 1) AS h, coalesce(parts, substr(message, cut_at + 2)) AS body FROM cut),
fields AS (SELECT *, """ + ", ".join(
    rf"nullif(regexp_extract(h, '(?i)(?:^|\n){f}:[ \t]*([^\n]*(?:\n[ \t][^\n]*)*)', 1), '') AS \"{H.column_name(f)}\""
    if f != "Subject" else
    rf"regexp_extract(h, '(?i)(?:^|\n){f}:[ \t]*([^\n]*(?:\n[ \t][^\n]*)*)', 1) AS \"{H.column_name(f)}\""
    for f in K.HEADER_FIELDS).replace('\\"', '"') + " FROM parsed)"
_FIELD_COLS = ", ".join(f'"{H.column_name(f)}"' for f in K.HEADER_FIELDS)


@query(E(f"SELECT email_id, {_FIELD_COLS}, body FROM fields", Q.RAW, _PARSED))
def parsed_headers(spark, sf):
    return H.parse_headers(_raw(spark, sf)).select(
        "email_id", *[H.column_name(f) for f in K.HEADER_FIELDS], "body")


@query(E("""SELECT email_id, subject, "from" FROM fields""", Q.RAW, _PARSED))
def parsed_chosen_headers(spark, sf):
    return H.parse_headers(_raw(spark, sf), fields=["Subject", "From"]).select("email_id", "subject", "from")


@query(E("SELECT email_id, body FROM parsed", Q.RAW, _PARSED))
def message_bodies(spark, sf):
    return _raw(spark, sf).select("email_id", H.payload(H.split_message(F.col("message"))).alias("body"))


@query(E(r"""SELECT email_id, regexp_extract(x, '^([^:]*):', 1) AS name,
    regexp_replace(regexp_extract(x, '^[^:]*:((?s).*)$', 1), '^[ \t]+', '') AS value
    FROM (SELECT email_id, unnest(string_split(regexp_replace(h, '\n([^ \t])', chr(1) || '\1', 'g'), chr(1))) AS x
          FROM parsed)""", Q.RAW, _PARSED))
def header_pairs(spark, sf):
    h = H.split_message(F.col("message"))["header"]
    return _raw(spark, sf).select("email_id", F.inline(H.header_pairs(h)))


_BLOCK = """blocks AS (SELECT email_id, CASE WHEN instr(body, chr(10) || chr(10)) > 0
    THEN substr(body, 1, instr(body, chr(10) || chr(10)) - 1) ELSE '' END AS header,
  CASE WHEN instr(body, chr(10) || chr(10)) > 0 THEN substr(body, instr(body, chr(10) || chr(10)) + 2)
       ELSE body END AS rest FROM parsed)"""
_HEADER_LINE = (r"(?i)^\s*(" + "|".join(K.BODY_HEADER_NAMES) + r"|x-[\w-]+)\s*:")


@query(E("SELECT email_id, header, rest AS body FROM blocks", Q.RAW, _PARSED, _BLOCK))
def header_body_split(spark, sf):
    body = H.payload(H.split_message(F.col("message")))
    return _raw(spark, sf).select("email_id", X.split_header_body(body).alias("s")).select("email_id", "s.*")


_HEADER_MAP = rf"""lines AS (
  SELECT email_id, unnest(l) AS line, generate_subscripts(l, 1) AS n
  FROM (SELECT email_id, string_split(header, chr(10)) AS l FROM blocks WHERE header <> '')
), heads AS (
  SELECT *, regexp_matches(line, '{_HEADER_LINE}') AS is_head,
    count(*) FILTER (regexp_matches(line, '{_HEADER_LINE}')) OVER (PARTITION BY email_id ORDER BY n) AS g FROM lines
), joined AS (
  SELECT email_id, g, lower(trim(first(split_part(line, ':', 1) ORDER BY n))) AS name,
    trim(string_agg(CASE WHEN is_head THEN trim(substr(line, instr(line, ':') + 1)) ELSE {Q.strip('line')} END, ' ' ORDER BY n)) AS value
  FROM heads WHERE g > 0 AND (is_head OR regexp_matches(line, '^[ \t]')) GROUP BY email_id, g
), hmap AS (SELECT email_id, name, last(value ORDER BY g) AS value FROM joined GROUP BY email_id, name)"""


@query(E("SELECT email_id, name, value FROM hmap", Q.RAW, _PARSED, _BLOCK, _HEADER_MAP))
def header_map(spark, sf):
    body = H.payload(H.split_message(F.col("message")))
    m = H.header_map(X.split_header_body(body)["header"])
    return _raw(spark, sf).select("email_id", F.explode(m).alias("name", "value"))


_FILL = """filled AS (SELECT f.email_id, """ + ", ".join(
    f"""trim(coalesce(f."{c}", '')) = '' AND max(CASE WHEN m.name = '{n}' THEN m.value END) IS NOT NULL AS "{c}_filled",
    CASE WHEN trim(coalesce(f."{c}", '')) = '' THEN coalesce(max(CASE WHEN m.name = '{n}' THEN m.value END), f."{c}")
         ELSE f."{c}" END AS "{c}" """ for n, c in K.BACKFILL_COLUMNS.items()) + """
  FROM fields f LEFT JOIN hmap m ON m.email_id = f.email_id GROUP BY f.email_id, """ + ", ".join(
    f'f."{c}"' for c in K.BACKFILL_COLUMNS.values()) + ")"


@query(E(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) FILTER ("{c}_filled") AS n_filled FROM filled"""
    for c in K.BACKFILL_COLUMNS.values()), Q.RAW, _PARSED, _BLOCK, _HEADER_MAP, _FILL))
def backfill_counts(spark, sf):
    return QA.backfill_counts(QA.backfill_headers(H.parse_headers(_raw(spark, sf))))


@query(E(f"SELECT email_id, {_FIELD_COLS} FROM filled", Q.RAW, _PARSED, _BLOCK, _HEADER_MAP, _FILL))
def backfilled_headers(spark, sf):
    return QA.backfill_headers(H.parse_headers(_raw(spark, sf))).select(
        "email_id", *[H.column_name(f) for f in K.HEADER_FIELDS])


_NO_HEADER_LINES = rf"""{Q.strip(f'''array_to_string(list_filter(string_split(BODY, chr(10)),
    lambda k: NOT regexp_matches(k, '{_HEADER_LINE}')), chr(10))''')}"""


@query(E(f"SELECT email_id, {_NO_HEADER_LINES.replace('BODY', 'body')} AS body FROM parsed", Q.RAW, _PARSED))
def bodies_without_header_lines(spark, sf):
    body = H.payload(H.split_message(F.col("message")))
    return _raw(spark, sf).select("email_id", X.drop_header_lines(body).alias("body"))


def _sql_addresses(c):
    angle = rf"regexp_extract_all({c}, '<\s*([^<>@\s]+@[^<>@\s]+)\s*>', 1)"
    plain = rf"regexp_extract_all({c}, '(?i)[A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{{2,}}')"
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN len({angle}) > 0 THEN array_to_string({angle}, ', ') "
            f"WHEN len({plain}) > 0 THEN array_to_string({plain}, ', ') ELSE {Q.corpus_clean(c)} END")


@query(E(f"""SELECT email_id, {_sql_addresses('"from"')} AS "from", {_sql_addresses("sender")} AS sender FROM fields""",
         Q.RAW, _PARSED))
def address_fields(spark, sf):
    return H.parse_headers(_raw(spark, sf)).select(
        "email_id", H.normalise_addresses(F.col("from")).alias("from"),
        H.normalise_addresses(F.col("sender")).alias("sender"))


@query(E(f"""SELECT email_id, {Q.corpus_clean('message_id', True)} AS message_id, {Q.corpus_clean('subject')} AS subject,
             {Q.corpus_clean('body')} AS body, {Q.corpus_clean('list_id')} AS list_id FROM fields""", Q.RAW, _PARSED))
def cleaned_text_columns(spark, sf):
    parsed = H.parse_headers(_raw(spark, sf))
    return parsed.select("email_id", *[
        PC.clean_column(c, F.col(c)).alias(c) for c in ("message_id", "subject", "body", "list_id")])


_URLS = r"regexp_extract_all(message, '((?:https?://|www\.)[^\s,\)\]>\[}]+)')"


@query(E(f"""SELECT email_id, CASE WHEN len({_URLS}) > 0 THEN array_to_string({_URLS}, '|') END AS urls,
             CAST(len({_URLS}) AS INTEGER) AS num_urls FROM raw""", Q.RAW))
def message_urls(spark, sf):
    found = U.raw_urls(F.col("message"))
    return _raw(spark, sf).select("email_id", bars(found).alias("urls"),
                                  F.coalesce(F.size(found), F.lit(0)).alias("num_urls"))


def _sql_final(c):
    if c in ("from", "to", "sender"):
        return f'{_sql_addresses(chr(34) + c + chr(34))} AS "{c}"'
    return f"""{Q.corpus_clean(chr(34) + c + chr(34), c == 'message_id')} AS "{c}" """


_FINAL = f"""firsts AS (SELECT min(email_id) AS email_id, message FROM raw GROUP BY message),
final_rows AS (SELECT DISTINCT """ + ", ".join(_sql_final(c) for c in K.EMAIL_COLUMNS[:9]) + f""", num_urls, label
  FROM (SELECT l.*, p.body, nullif(array_to_string({_URLS.replace('message', 'p.message')}, ', '), '') AS urls,
               CAST(len({_URLS.replace('message', 'p.message')}) AS INTEGER) AS num_urls, p.label
        FROM (SELECT email_id, {_FIELD_COLS} FROM filled) l JOIN parsed p USING (email_id) JOIN firsts USING (email_id)))"""
_CLEAN = (Q.RAW, _PARSED, _BLOCK, _HEADER_MAP, _FILL, _FINAL)


@query(E("SELECT * FROM final_rows", *_CLEAN))
def cleaned_corpus(spark, sf):
    return PC.clean_corpus(_raw(spark, sf))


@query(E("SELECT * FROM final_rows", *_CLEAN))
def corpus_csv_round_trip(spark, sf):
    path = _scratch(spark, "corpus-csv")
    PC.run(_raw(spark, sf), path, "csv")
    return FS.corpus_csv(spark, path)


@query("""SELECT page_id, """ + Q.squeeze(
    r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?>.*?</script>', ' ', 'g'), "
    r"'(?is)<style.*?>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g')") + " AS text FROM pages")
def html_stripped(spark, sf):
    return C.table(spark, sf, "pages").select("page_id", X.strip_html(F.col("html")).alias("text"))


def _sql_entities(c):
    for name, char in X._ENTITIES.items():
        c = f"replace({c}, {Q.q(name)}, {Q.q(char)})"
    return c


def _sql_html_text():
    t = "html"
    for tag in ("script", "style", "noscript", "iframe"):
        t = rf"regexp_replace({t}, '(?is)<{tag}\b[^>]*>.*?</{tag}\s*>', chr(1), 'g')"
    t = f"regexp_replace({t}, '(?s)<!--.*?-->', chr(1), 'g')"
    t = f"regexp_replace({t}, '</?[a-zA-Z][^>]*>|<[!?][^>]*>', chr(1), 'g')"
    t = rf"regexp_replace({t}, '\x01+', chr(10), 'g')"
    t = _sql_entities(_sql_entities(t))
    return Q.strip(rf"regexp_replace({t}, '[ \t]+\n', chr(10), 'g')")


@query(f"SELECT page_id, {_sql_html_text()} AS text FROM pages")
def html_text(spark, sf):
    return C.table(spark, sf, "pages").select("page_id", X.html_to_text(F.col("html")).alias("text"))


# --- text normalisation ------------------------------------------------------------------

@query(E(f"SELECT email_id, {Q.clean('subject')} AS subject, {Q.clean('urls')} AS urls FROM emails"))
def placeholder_clean(spark, sf):
    return _mails(spark, sf).select("email_id", X.clean_value(F.col("subject")).alias("subject"),
                                    X.clean_value(F.col("urls")).alias("urls"))


@query(E("SELECT email_id, coalesce(urls, '') AS urls, '' AS url, CAST(label AS INTEGER) AS label FROM emails"))
def filled_columns(spark, sf):
    return X.fill_text(_mails(spark, sf), ["urls", "url"]).select(
        "email_id", "urls", "url", F.col("label").cast("int").alias("label"))


@query(E("""SELECT email_id, CASE WHEN email_id % 3 = 0 THEN 'a@b.com' ELSE "from" END AS sender FROM emails"""))
def sender_choice(spark, sf):
    n = F.col("email_id")
    m = _mails(spark, sf).withColumn("sender_email", F.when(n % 3 == 0, "a@b.com").when(n % 3 == 1, ""))
    return m.select("email_id", H.pick_sender(m).alias("sender"))


@query(E(f"SELECT email_id, {Q.normal('body')} AS text FROM emails"))
def normalised_text(spark, sf):
    return _mails(spark, sf).select("email_id", X.normalise(F.col("body")).alias("text"))


@query(E(f"""SELECT email_id, {Q.strip(f'''concat_ws(' ', 'subject ' || {Q.clean('subject')}, 'body ' || {Q.clean('body')},
    'sender ' || {Q.clean('"from"')}, 'urls ' || {Q.clean('urls')})''')} AS text FROM emails"""))
def combined_text(spark, sf):
    cols = [F.col(c) for c in ("subject", "body", "from", "urls")]
    return _mails(spark, sf).select("email_id", X.combined_text(*cols).alias("text"))


@query(E(f"""SELECT email_id, {Q.strip("replace(replace(body, '=' || chr(13) || chr(10), ''), '=3D', '=')")} AS body FROM (
    SELECT email_id, regexp_replace(body, 'e', '=3D', 'g') AS body FROM emails)"""))
def quoted_remnants(spark, sf):
    raw = F.concat(F.lit("Content-Type: text/plain; charset=x\r\n\r\n"),
                   F.regexp_replace(F.col("body"), "e", "=3D"), F.lit("\r\n--end--"))
    return _mails(spark, sf).select("email_id", X.plain_part(raw, F.lit("")).alias("body"))


@query(E("""SELECT email_id, array_to_string(list_transform(regexp_extract_all(body, '[A-Za-z][A-Za-z''-]{2,}'),
    lambda k: trim(lower(k), '''')), '|') AS tokens FROM emails"""))
def keyword_tokens(spark, sf):
    return _mails(spark, sf).select("email_id", bars(X.keyword_tokens(F.col("body"))).alias("tokens"))


@query(E(f"""SELECT email_id, coalesce(string_agg(tok, '|' ORDER BY pos), '') AS words FROM (
  SELECT email_id, tok, min(pos) AS pos FROM (
    SELECT email_id, unnest(x) AS tok, generate_subscripts(x, 1) AS pos FROM (
      SELECT email_id, list_transform(regexp_extract_all(body, '[A-Za-z][A-Za-z''-]{{2,}}'),
             lambda k: trim(lower(k), '''')) AS x FROM emails))
  WHERE tok NOT LIKE '%ly' AND tok NOT IN {Q.in_list(K.COMMON_WORDS + K.POSITIVE_WORDS + K.WEAK_SIGNAL_WORDS)}
  GROUP BY email_id, tok) RIGHT JOIN emails USING (email_id) GROUP BY email_id"""))
def candidate_keywords(spark, sf):
    return _mails(spark, sf).select("email_id", bars(X.candidate_keywords(F.col("body"))).alias("words"))


# --- domains -----------------------------------------------------------------------------

@query(f"SELECT DISTINCT h AS host, {Q.reg('h')} AS registrable FROM (SELECT {Q.host_of('url')} AS h FROM pages)")
def registrable_domains(spark, sf):
    host = U.hostname(F.col("url"))
    return C.table(spark, sf, "pages").select(
        host.alias("host"), U.registrable(host, SUF).alias("registrable")).distinct()


@query(f"""WITH rules(tail) AS {Q.values([(s,) for s in SUF])},
hosts AS (SELECT DISTINCT {Q.host_of('url')} AS h FROM pages),
best AS (SELECT h, max(length(tail)) AS n FROM hosts JOIN rules ON ends_with(h, '.' || tail) GROUP BY h)
SELECT h AS host, coalesce(regexp_extract(substr(h, 1, length(h) - n - 1), '[^.]*$', 0) || substr(h, length(h) - n), h) AS registrable
FROM hosts LEFT JOIN best USING (h)""")
def registrable_domains_by_table(spark, sf):
    pages = C.table(spark, sf, "pages")
    rules = spark.createDataFrame([(s,) for s in SUF], "suffix string")
    return D.registrable_by_table(pages.select(U.hostname(F.col("url")).alias("host")), rules)


@query(E(f"""SELECT email_id, array_to_string(list_transform({Q.text_hosts('body')}, lambda k: {Q.reg('k')}), '|') AS domains
             FROM emails"""))
def text_domains(spark, sf):
    return _mails(spark, sf).select("email_id", bars(U.text_domains(F.col("body"), SUF)).alias("domains"))


_REP_COLS = ", ".join(K.REPUTATION_COLUMNS)


@query(E(f"SELECT {_REP_COLS} FROM reputation", Q.reputation()))
def domain_reputation(spark, sf):
    return D.sorted_reputation(D.reputation(_mails(spark, sf), SUF))


@query(E(f"SELECT {_REP_COLS} FROM reputation WHERE legitimacy_score >= 70", Q.reputation()))
def legitimate_domains(spark, sf):
    return D.legitimate(D.reputation(_mails(spark, sf), SUF))


@query(E(f"SELECT {_REP_COLS} FROM reputation WHERE legitimacy_score >= 70", Q.reputation()))
def written_reputation(spark, sf):
    full, good = _scratch(spark, "full"), _scratch(spark, "legitimate")
    SK.write_reputation(D.reputation(_mails(spark, sf), SUF), full, good)
    return spark.read.parquet(good)


@query(E("""SELECT row_number() OVER (ORDER BY legitimacy_score DESC, domain) AS rank, domain
            FROM reputation WHERE legitimacy_score >= 70""", Q.reputation()))
def ranked_sites(spark, sf):
    return FS.site_list(D.legitimate(D.reputation(_mails(spark, sf), SUF)))


@query(E("SELECT urls FROM emails WHERE label = 0 AND urls IS NOT NULL"))
def safe_url_lines(spark, sf):
    path = _scratch(spark, "safe-urls")
    SK.write_safe_urls(_mails(spark, sf), path)
    return spark.read.text(path).withColumnRenamed("value", "urls")


@query(E(f"""SELECT DISTINCT {Q.reg('h')} AS domain FROM (
  SELECT {Q.host_of('u')} AS h FROM (SELECT trim(unnest(string_split(urls, ','))) AS u FROM emails WHERE label = 0))
  WHERE h <> ''"""))
def safe_hosts(spark, sf):
    path = _scratch(spark, "safe-urls")
    SK.write_safe_urls(_mails(spark, sf), path)
    return FS.safe_hosts(spark, path, SUF)


@query(E("SELECT DISTINCT lower(trim(\"from\")) AS line FROM emails"))
def line_list(spark, sf):
    path = _scratch(spark, "lines")
    _mails(spark, sf).select("from").write.text(path)
    return FS.line_list(spark, path)


@query(E("SELECT domain FROM reputation", Q.reputation()))
def domain_list_csv(spark, sf):
    path = _scratch(spark, "domains")
    D.reputation(_mails(spark, sf), SUF).write.option("header", True).csv(path)
    return FS.domain_list_csv(spark, path)


@query(E(f"SELECT {_REP_COLS} FROM reputation", Q.reputation()))
def reputation_csv(spark, sf):
    path = _scratch(spark, "reputation")
    D.reputation(_mails(spark, sf), SUF).write.option("header", True).option("emptyValue", "").csv(path)
    return FS.reputation_csv(spark, path)


@query(Q.ctes(Q.HOSTS, final="SELECT domain FROM trusted UNION SELECT domain FROM safe"))
def trusted_union(spark, sf):
    return D.trusted_union(C.trusted_deck(spark, sf), C.safe_deck(spark, sf))


@query(E("""SELECT domain, domain IN (SELECT domain FROM trusted) AS is_trusted,
            domain IN (SELECT domain FROM safe) AS is_safe FROM reputation""", Q.HOSTS, Q.reputation()))
def trusted_flags(spark, sf):
    rows = D.reputation(_mails(spark, sf), SUF).select("domain")
    rows = D.membership(rows, C.trusted_deck(spark, sf), "domain", F.col("domain"), "is_trusted")
    return D.membership(rows, C.safe_deck(spark, sf), "domain", F.col("domain"), "is_safe")


# --- senders -------------------------------------------------------------------------------

@query(E(f"""SELECT email_id, {Q.mailbox_host('"from"')} AS mailbox, {Q.TEXT_HOST.format(c='"from"')} AS text,
  lower(regexp_extract({Q.clean('"from"')}, '@([^\\s>]+)', 1)) AS feature FROM emails"""))
def sender_hosts(spark, sf):
    c = F.col("from")
    return _mails(spark, sf).select("email_id", H.mailbox_host(c).alias("mailbox"), H.text_host(c).alias("text"),
                                    H.feature_host(c).alias("feature"))


_SENDER_COLS = ["email_id", "sender_host", "sender_score", "sender_occurrences", "sender_in_spam", "sender_in_ham",
                "sender_sources", "sender_category", "lookup_status"]


@query(E(f"SELECT {', '.join(_SENDER_COLS)} FROM found", Q.reputation(), Q.sender("emails", Q.mailbox_host('"from"'))))
def sender_reputation(spark, sf):
    m = _mails(spark, sf)
    return SE.sender_reputation(m.select("email_id", "from"), D.reputation(m, SUF)).select(*_SENDER_COLS)


@query(E(f"SELECT {', '.join(_SENDER_COLS)} FROM found", Q.reputation(), Q.sender(
    "emails", f"""CASE WHEN {Q.mailbox_host('"from"')} = '' THEN '' ELSE {Q.reg(Q.mailbox_host('"from"'))} END""")))
def sender_reputation_by_registrable(spark, sf):
    m = _mails(spark, sf)
    return SE.sender_reputation(m.select("email_id", "from"), D.reputation(m, SUF), by="registrable",
                                suffixes=SUF).select(*_SENDER_COLS)


# --- lexicon ---------------------------------------------------------------------------------

_LEX_COLS = "email_id, keyword_part, phrase_part, bonus_part, keyword_score, " \
            "CASE WHEN keyword_score >= 50 THEN 'Spam' ELSE 'Safe' END AS keyword_label, matched, keywords"


@query(E(f"SELECT {_LEX_COLS} FROM lex", Q.lexicon()))
def lexicon_scores(spark, sf):
    return LX.lexicon_score(_mails(spark, sf)).select(
        "email_id", "keyword_part", "phrase_part", "bonus_part", "keyword_score", "keyword_label",
        bars("matched").alias("matched"), bars("keywords").alias("keywords"))


@query(E("SELECT email_id, term, CAST(s AS BIGINT) AS subject_hits, CAST(b AS BIGINT) AS body_hits FROM kw", Q.lexicon()))
def keyword_hits(spark, sf):
    terms = spark.createDataFrame([(k,) for k in K.KEYWORD_WEIGHTS], "term string")
    return LX.keyword_hits(_mails(spark, sf), terms).select("email_id", "term", "subject_hits", "body_hits")


@query(E("SELECT email_id, phrase, CAST(hits AS INTEGER) AS hits FROM ph", Q.lexicon()))
def phrase_hits(spark, sf):
    return LX.phrase_hits(_mails(spark, sf))


@query(E(f"""SELECT email_id, CAST(len(list_filter(regexp_extract_all(lower(body), '{Q.W}+'), lambda k: k = 'verify')) AS INTEGER)
             AS n_verify, CAST(len(list_filter(regexp_extract_all(lower(body), '{Q.W}+'), lambda k: k = lang)) AS INTEGER) AS n_lang
             FROM emails"""))
def term_counts(spark, sf):
    return _mails(spark, sf).select("email_id", X.count_term(F.col("body"), "verify").alias("n_verify"),
                                    X.count_term(F.col("body"), F.col("lang")).alias("n_lang"))


@query(E(rf"""SELECT t.email_id,
   CASE WHEN matched = '' THEN subject ELSE regexp_replace(subject, '(?i)\b(' || alt || ')\b', '{K.HIGHLIGHT_OPEN}\1{K.HIGHLIGHT_CLOSE}', 'g') END
     AS subject_highlighted
  FROM texts t JOIN (SELECT *, (SELECT string_agg(k, '|' ORDER BY length(k) DESC, k) FROM unnest(string_split(matched, '|')) u(k)) AS alt
                     FROM lex) USING (email_id)""", Q.lexicon()))
def highlighted_subjects(spark, sf):
    return LX.highlighted(LX.lexicon_score(_mails(spark, sf))).select("email_id", "subject_highlighted")


def _marked(c):
    """Keywords of column ``alt`` as whole words in a text.  A mark behind every separator keeps neighbouring
    matches apart."""
    split = f"regexp_replace({c}, '({Q.NW})', '\\1' || chr(1), 'g')"
    return (f"CASE WHEN matched = '' THEN {c} ELSE replace(regexp_replace({split}, '(?i)(^|{Q.NW})(' || alt || ')($|{Q.NW})', "
            f"'\\1{K.HIGHLIGHT_OPEN}\\2{K.HIGHLIGHT_CLOSE}\\3', 'g'), chr(1), '') END")


@query(E(f"""SELECT email_id, {_marked("coalesce(subject, '')")} AS subject_highlighted, {_marked("coalesce(body, '')")} AS body_highlighted
  FROM emails JOIN (SELECT email_id, matched, (SELECT string_agg(regexp_replace(k, '({Q.NW})', '\\1' || chr(1), 'g'), '|' ORDER BY length(k) DESC, k)
    FROM unnest(string_split(matched, '|')) u(k)) AS alt FROM lex) USING (email_id)""", Q.lexicon()))
def highlighted_mails(spark, sf):
    return LX.highlighted(LX.lexicon_score(_mails(spark, sf))).select(
        "email_id", "subject_highlighted", "body_highlighted")


@query(E(f"""SELECT email_id, coalesce(string_agg(DISTINCT w, '|' ORDER BY w), '') AS words FROM (
  SELECT email_id, lower(trim(unnest(string_split(body, ' ')))) AS w FROM emails)
  WHERE length(w) BETWEEN 3 AND 30 AND NOT contains(w, 'http') AND NOT contains(w, 'www')
    AND regexp_full_match(w, '[a-zA-Z][a-zA-Z-]*') GROUP BY email_id"""))
def cleaned_keywords(spark, sf):
    words = X.clean_keywords(F.split("body", " "))
    return _mails(spark, sf).select("email_id", bars(words).alias("words")).where("words <> ''")


# --- links -------------------------------------------------------------------------------------

_CELLS = r"""cells AS (SELECT email_id, "from", urls, list_filter(list_transform(regexp_split_to_array(coalesce(urls, ''), '[\s,]+'),
   lambda k: trim(k, ' <>()[]{}"''')), lambda k: k <> '') AS c FROM emails),
cell_urls AS (SELECT email_id, "from", unnest(c) AS url, generate_subscripts(c, 1) AS pos FROM cells)"""


def _cell_urls(spark, sf):
    m = _mails(spark, sf)
    return m.select("email_id", "from", F.posexplode(U.url_cell_candidates(F.col("urls"))).alias("pos", "url"))


@query(E("SELECT email_id, array_to_string(c, '|') AS urls FROM cells", _CELLS))
def url_candidates(spark, sf):
    return _mails(spark, sf).select("email_id", bars(U.url_cell_candidates(F.col("urls"))).alias("urls"))


@query(E(f"SELECT DISTINCT url, {Q.host_of('url')} AS host FROM cell_urls", _CELLS))
def url_hosts(spark, sf):
    return _cell_urls(spark, sf).select("url", U.hostname(F.col("url")).alias("host")).distinct()


@query(E(f"""SELECT email_id, string_agg(d, '|' ORDER BY pos) AS domains FROM (
   SELECT email_id, d, min(pos) AS pos FROM (SELECT email_id, unnest(x) AS d, generate_subscripts(x, 1) AS pos
     FROM (SELECT email_id, {Q.body_hosts('body')} AS x FROM emails)) GROUP BY ALL) RIGHT JOIN emails USING (email_id) GROUP BY email_id"""))
def body_domains(spark, sf):
    return _mails(spark, sf).select("email_id", bars(U.body_domains(F.col("body"), SUF)).alias("domains"))


@query(E("SELECT url, hostname, coalesce(registrable, '') AS registrable, error FROM prep",
         _CELLS, Q.prepared("cell_urls")))
def url_validation(spark, sf):
    rows = _cell_urls(spark, sf).select("url").distinct()
    h = U.prepared_host(F.col("url"), SUF)
    return rows.select("url", h["hostname"].alias("hostname"),
                       U.normalised_registrable(F.col("url"), SUF).alias("registrable"), h["error"].alias("error"))


@query(E("SELECT hostname, structure AS reason FROM (SELECT DISTINCT hostname, structure FROM f1 WHERE error = '')",
         Q.HOSTS, _CELLS, Q.facts("cell_urls")))
def url_structure(spark, sf):
    h = U.prepared_host(F.col("url"), SUF)
    rows = _cell_urls(spark, sf).select(h.alias("h")).where("h.error = ''").select("h.*").distinct()
    return rows.select("hostname", U.structural_reason(F.col("hostname"), F.col("registrable")).alias("reason")).distinct()


@query(E(f"SELECT DISTINCT url, {Q.base('url')} AS base FROM cell_urls", _CELLS))
def base_domains(spark, sf):
    return _cell_urls(spark, sf).select("url", U.base_domain(F.col("url")).alias("base")).distinct()


@query(E(f"""SELECT DISTINCT registrable AS domain, array_to_string(list_filter(regexp_split_to_array({Q.label_of('registrable')},
   '[^a-z0-9]+'), lambda k: k <> ''), '|') AS tokens FROM prep WHERE error = ''""", _CELLS, Q.prepared("cell_urls")))
def label_tokens(spark, sf):
    h = U.prepared_host(F.col("url"), SUF)["registrable"]
    rows = _cell_urls(spark, sf).select(h.alias("domain")).where("domain is not null").distinct()
    return rows.select("domain", bars(U.label_tokens(U.domain_label(F.col("domain"), SUF))).alias("tokens"))


_ASSESSED = f"""assessed AS (SELECT email_id, pos - 1 AS pos, url, {Q.DECIDE}
  FROM (SELECT *, {Q.registrable_sender(Q.TEXT_HOST.format(c='"from"'))} AS srd FROM cell_urls) l JOIN facts f USING (url))"""


@query(E("""SELECT email_id, CAST(pos AS INTEGER) AS pos, url, status, reason, domain, status = 'trusted' AS is_trusted,
            status = 'suspicious' AS is_suspicious, closest_trusted, lookalike_distance FROM assessed""",
         Q.HOSTS, _CELLS, Q.facts("cell_urls"), _ASSESSED))
def link_assessment(spark, sf):
    rows = _cell_urls(spark, sf).withColumn("sender_domain", H.text_host(F.col("from")))
    return LK.assess(rows, C.trusted_deck(spark, sf), C.safe_deck(spark, sf), F.struct("email_id", "pos"), SUF).select(
        "email_id", "pos", "url", "status", "reason", "domain", "is_trusted", "is_suspicious", "closest_trusted",
        "lookalike_distance")


@query(E("""SELECT url, CASE status WHEN 'trusted' THEN 'Safe' WHEN 'aligned' THEN 'Matches sender' WHEN 'normal' THEN 'Looks normal'
  ELSE 'Suspicious' END AS display, CASE WHEN closest_trusted <> '' AND lookalike_distance BETWEEN 1 AND 2 THEN closest_trusted END AS closest,
  count(*) AS n FROM assessed GROUP BY ALL""", Q.HOSTS, _CELLS, Q.facts("cell_urls"), _ASSESSED))
def link_display(spark, sf):
    rows = link_assessment(spark, sf)
    return rows.groupBy("url", LK.display_status(F.col("status")).alias("display"), LK.display_closest(
        F.col("lookalike_distance"), F.col("closest_trusted")).alias("closest")).agg(F.count("*").alias("n"))


@query(Q.ctes(Q.HOSTS, final=rf"""SELECT brand, min(domain) AS site FROM (
  SELECT domain, regexp_extract(domain, '^([^.]+)[.](?:{Q._ALT})$', 1) AS brand FROM trusted) WHERE brand <> '' GROUP BY brand"""))
def brand_map(spark, sf):
    return LA.brand_map(C.trusted_deck(spark, sf), SUF)


_REP_FACTS = (Q.HOSTS, Q.reputation(), Q.facts("reputation", "domain"))


@query(E("""SELECT DISTINCT registrable AS domain, brand_site AS closest, CAST(brand_distance AS INTEGER) AS distance,
            brand_reason AS reason FROM facts WHERE brand_site IS NOT NULL""", *_REP_FACTS))
def brand_imitations(spark, sf):
    trusted, safe = C.trusted_deck(spark, sf), C.safe_deck(spark, sf)
    facts = LK.url_facts(D.reputation(_mails(spark, sf), SUF), trusted, safe, SUF, url="domain")
    return facts.where("brand_site is not null").select(
        F.col("registrable").alias("domain"), F.col("brand_site").alias("closest"),
        F.col("brand_distance").alias("distance"), F.col("brand_reason").alias("reason")).distinct()


@query(E("""SELECT domain, CAST(dist AS INTEGER) AS distance, site AS closest FROM (
   SELECT r.domain, t.domain AS site, levenshtein(r.domain, t.domain) AS dist FROM reputation r, trusted t)
   QUALIFY row_number() OVER (PARTITION BY domain ORDER BY dist, site) = 1""", Q.HOSTS, Q.reputation()))
def nearest_sites(spark, sf):
    return LA.nearest_sites(D.reputation(_mails(spark, sf), SUF), C.trusted_deck(spark, sf))


@query(E("""SELECT r.domain AS domain, t.domain AS site, CAST(levenshtein(r.domain, t.domain) AS INTEGER) AS distance
   FROM reputation r, trusted t WHERE levenshtein(r.domain, t.domain) <= 2""", Q.HOSTS, Q.reputation()))
def close_sites(spark, sf):
    found = LA.edit_neighbours(D.reputation(_mails(spark, sf), SUF).select(F.col("domain").alias("left")),
                               C.trusted_deck(spark, sf).select(F.col("domain").alias("right")))
    return found.select(F.col("left").alias("domain"), F.col("right").alias("site"), "distance")


_LISTED = f"""WITH h AS (SELECT DISTINCT regexp_replace({Q.host_of('url')}, '^(www|m|blog)[.]', '') AS h, page_id % 3 = 0 AS listed FROM pages),
near AS (SELECT a.h AS domain, b.h AS site, levenshtein(a.h, b.h) AS dist FROM (SELECT DISTINCT h FROM h) a, h b WHERE b.listed
  QUALIFY row_number() OVER (PARTITION BY a.h ORDER BY levenshtein(a.h, b.h), b.h) = 1)"""


def _listed_hosts(spark, sf):
    """The hosts of every third page, as a list of sites."""
    host = F.regexp_replace(U.hostname(F.col("url")), r"^(www|m|blog)[.]", "")
    return C.table(spark, sf, "pages").where("page_id % 3 = 0").select(host.alias("domain")).distinct()


@query(_LISTED + "SELECT domain, CAST(dist AS INTEGER) AS distance, site AS closest FROM near WHERE dist BETWEEN 1 AND 2")
def look_alikes(spark, sf):
    return LA.look_alikes(_page_hosts(spark, sf).withColumnRenamed("host", "domain"), _listed_hosts(spark, sf))


@query(_LISTED + "SELECT domain, CAST(dist AS INTEGER) AS distance, site AS closest FROM near")
def nearest_page_hosts(spark, sf):
    """A long list of sites: gap keys, pieces and blocks all take part."""
    return LA.nearest_sites(_page_hosts(spark, sf).withColumnRenamed("host", "domain"), _listed_hosts(spark, sf))


@query(f"""WITH RECURSIVE h AS (SELECT DISTINCT regexp_replace({Q.host_of('url')}, '^(www|m|blog)[.]', '') AS h FROM pages),
e AS (SELECT a.h AS x, b.h AS y FROM h a, h b WHERE levenshtein(a.h, b.h) <= 2),
reach AS (SELECT h AS x, h AS y FROM h UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x)
SELECT x AS host, min(y) AS representative FROM reach GROUP BY x""")
def look_alike_groups(spark, sf):
    return LA.look_alike_groups(_page_hosts(spark, sf), "host")


@query(f"""WITH h AS (SELECT DISTINCT regexp_replace({Q.host_of('url')}, '^(www|m|blog)[.]', '') AS h FROM pages)
SELECT a.h AS left_host, b.h AS right_host, CAST(levenshtein(a.h, b.h) AS INTEGER) AS distance
FROM h a, h b WHERE a.h < b.h AND levenshtein(a.h, b.h) <= 2""")
def close_page_hosts(spark, sf):
    rows = _page_hosts(spark, sf).withColumnRenamed("host", "left")
    found = LA.edit_neighbours(rows, rows.withColumnRenamed("left", "right"))
    return found.where(F.col("left") < F.col("right")).select(
        F.col("left").alias("left_host"), F.col("right").alias("right_host"), "distance")


@query(f"""SELECT DISTINCT {Q.host_of('url')} AS host, CAST(levenshtein({Q.host_of('url')}, 'google.com') AS INTEGER) AS distance FROM pages""")
def token_distance(spark, sf):
    host = U.hostname(F.col("url"))
    return C.table(spark, sf, "pages").select(
        host.alias("host"), F.levenshtein(host, F.lit("google.com")).alias("distance")).distinct()


# --- features ------------------------------------------------------------------------------------

def _sql_features(sender, urls):
    """The 15 features; the source has subject, body (cleaned), a sender domain and a URL cell."""
    t = Q.strip("subject || ' ' || body")
    sets = {"urgency_term_count": K.URGENCY_TERMS, "account_term_count": K.ACCOUNT_TERMS, "offer_term_count": K.OFFER_TERMS}

    def terms(words):
        single = [w for w in words if " " not in w]
        parts = [f"len(list_filter(runs, lambda k: k IN {Q.in_list(single)}))"]
        for phrase in (w for w in words if " " in w):
            parts.append(rf"len(regexp_extract_all(doubled, '(?:^|{Q.NW})" + phrase.replace(" ", "  ") + rf"(?:$|{Q.NW})'))")
        return " + ".join(parts)

    return rf"""ft AS (SELECT *, {t} AS t, lower({t}) AS low, {sender} AS sd,
      list_filter(list_transform(regexp_split_to_array({urls}, '[\s,]+'), lambda k: trim(k, ' <>()[]{{}}"''')), lambda k: k <> '') AS cu FROM fsrc),
    fr AS (SELECT *, regexp_extract_all(low, '{Q.W}+') AS runs, regexp_replace(low, '({Q.NW})', '\1\1', 'g') AS doubled,
      list_transform(cu, lambda k: {Q.host_of('k')}) AS hosts FROM ft),
    feats AS (SELECT email_id, """ + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in {
        "subject_length": "length(subject)", "body_length": "length(body)", "url_count": "len(cu)",
        "sender_domain_depth": "length(sd) - length(replace(sd, '.', ''))",
        "uppercase_token_count": f"len(list_filter(regexp_extract_all(t, '{Q.W}+'), lambda k: regexp_full_match(k, '[A-Z]{{3,}}')))",
        "exclamation_count": "length(t) - length(replace(t, '!', ''))",
        "digit_ratio": r"round_even(length(regexp_replace(t, '[^0-9]', '', 'g')) / greatest(length(regexp_replace(t, '\s+', '', 'g')), 1), 4)",
        "currency_symbol_count": "len(regexp_extract_all(low, '[$€£¥]|sgd|usd|eur|gbp'))",
        **{n: terms(w) for n, w in sets.items()},
        "sender_is_free_mail": f"sd IN {Q.in_list(K.FREE_MAIL_DOMAINS)}",
        "ip_url_count": r"len(list_filter(hosts, lambda k: regexp_matches(k, '^\d{1,3}([.]\d{1,3}){3}$')))",
        "hyphenated_url_count": "len(list_filter(hosts, lambda k: regexp_matches(k, '-[^-]*-')))",
        "link_token_count": r"len(regexp_extract_all(low, 'https?://|www[.]|bit[.]ly|tinyurl|click'))",
    }.items()) + " FROM fr)"


_FSRC = f"""fsrc AS (SELECT email_id, label, {Q.clean('subject')} AS subject, {Q.clean('body')} AS body, "from", {Q.clean('urls')} AS urls FROM emails)"""
_FEATURE_SD = f"lower(regexp_extract({Q.clean(chr(34) + 'from' + chr(34))}, '@([^\\s>]+)', 1))"
_FEATS = (_FSRC, _sql_features(_FEATURE_SD, "urls"))
_NUM = ", ".join(K.NUMERIC_COLUMNS)


@query(E(f"SELECT email_id, {_NUM} FROM feats", *_FEATS))
def numeric_features(spark, sf):
    return FE.training_features(_mails(spark, sf)).select("email_id", *K.NUMERIC_COLUMNS)


@query(E(f"""SELECT email_id, subject AS subject_text, body AS body_text, sd AS sender_domain, urls AS url_text,
  {Q.strip("'subject ' || subject || ' body ' || body || ' sender ' || sd || ' urls ' || urls")} AS combined_text FROM fr""", *_FEATS))
def training_text_frame(spark, sf):
    return FE.training_features(_mails(spark, sf)).select(
        "email_id", "subject_text", "body_text", "sender_domain", "url_text", "combined_text")


_SSRC = f"""fsrc AS (SELECT email_id, {Q.clean('subject')} AS subject, {Q.clean('body')} AS body, "from",
  concat_ws(', ', nullif({Q.clean('urls')}, ''), 'https://x-y-z.example.org/a') AS urls FROM emails)"""


@query(E(f"SELECT f.*, r.urls AS url_text FROM (SELECT email_id, {_NUM} FROM feats) f JOIN fr r USING (email_id)",
         _SSRC, _sql_features(_FEATURE_SD, "urls")))
def scoring_frame(spark, sf):
    m = _mails(spark, sf).withColumn("url", F.lit("https://x-y-z.example.org/a"))
    return FE.scoring_features(m).select("email_id", *K.NUMERIC_COLUMNS, "url_text")


# mails of which some cells are blank, null or placeholders
_BLANKED = """blanked AS (SELECT email_id, CASE WHEN email_id % 2 = 0 THEN subject ELSE '' END AS subject, CASE WHEN email_id % 3 = 0 THEN body ELSE 'nan' END AS body,
  CASE WHEN email_id % 5 = 0 THEN "from" END AS "from", CASE WHEN email_id % 7 = 0 THEN urls ELSE 'None' END AS urls,
  CASE WHEN email_id % 11 = 0 THEN 'x.org' END AS url, (email_id * 37 % 1000) / 1000 AS p FROM emails)"""
_CONTENT = " || ".join(Q.clean(c) for c in ('"from"', "subject", "body", "urls", "url"))


def _blanked(spark, sf):
    n = F.col("email_id")
    return C.with_probability(_mails(spark, sf)).select(
        "email_id", F.when(n % 2 == 0, F.col("subject")).otherwise("").alias("subject"),
        F.when(n % 3 == 0, F.col("body")).otherwise("nan").alias("body"), F.when(n % 5 == 0, F.col("from")).alias("from"),
        F.when(n % 7 == 0, F.col("urls")).otherwise("None").alias("urls"), F.when(n % 11 == 0, "x.org").alias("url"), "p")


@query(E(f"""SELECT email_id, {_CONTENT} <> '' AS has_content,
             coalesce(subject, '') || coalesce(body, '') || coalesce(url, '') <> '' AS admissible FROM blanked""", _BLANKED))
def content_checks(spark, sf):
    m = _blanked(spark, sf)
    return m.select("email_id", FE.has_content(m).alias("has_content"), FE.admissible(m).alias("admissible"))


# --- model ------------------------------------------------------------------------------------------

@query(E("""SELECT email_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(email_id || ':42'), email_id)
            <= round(0.2 * count(*) OVER (PARTITION BY label)) AS is_test FROM emails"""))
def stratified_split(spark, sf):
    return O.stratified_split(_mails(spark, sf).select("email_id", "label"), "email_id", "label").select(
        "email_id", "label", "is_test")


def _scored(spark, sf):
    return C.with_probability(_mails(spark, sf)).select("email_id", "label", "p")


_SCORED = "scored AS (SELECT email_id, label, (email_id * 37 % 1000) / 1000 AS p FROM emails)"
_CONF = """conf AS (SELECT count(*) FILTER (p >= 0.42 AND label = 1) AS true_positives, count(*) FILTER (p >= 0.42 AND label = 0) AS false_positives,
  count(*) FILTER (p < 0.42 AND label = 1) AS false_negatives, count(*) FILTER (p < 0.42 AND label = 0) AS true_negatives FROM scored)"""


@query(E("SELECT * FROM conf", _SCORED, _CONF))
def confusion_counts(spark, sf):
    return M.confusion(_scored(spark, sf))


@query(E("""SELECT round_even((true_positives + true_negatives) / (true_positives + true_negatives + false_positives + false_negatives), 4) AS accuracy,
  round_even(true_positives / (true_positives + false_positives), 4) AS "precision", round_even(true_positives / (true_positives + false_negatives), 4) AS recall,
  round_even(2 * true_positives / (2 * true_positives + false_positives + false_negatives), 4) AS f1, false_positives, false_negatives FROM conf""", _SCORED, _CONF))
def evaluation_rates(spark, sf):
    return M.rates(M.confusion(_scored(spark, sf)))


@query(E("""SELECT round_even((sum(CASE WHEN label = 1 THEN r END) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2)
  / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 4) AS roc_auc FROM (
  SELECT label, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS r FROM scored)""", _SCORED))
def roc_auc(spark, sf):
    return M.roc_auc(_scored(spark, sf))


_COMBINED = Q.strip("'subject ' || subject || ' body ' || body || ' sender ' || sd || ' urls ' || urls")
# the three term blocks: words and word pairs of subject and body, character n-grams of the combined text
_TERMS = rf"""words AS (SELECT email_id, block, list_filter(regexp_extract_all(lower(t), '{Q.W}{Q.W}+'), lambda k: k NOT IN {Q.in_list(K.STOP_WORDS)}) AS w
  FROM (SELECT email_id, 'subject_word' AS block, subject AS t FROM fr UNION ALL SELECT email_id, 'body_word', body FROM fr)),
padded AS (SELECT email_id, ' ' || unnest(string_split({Q.normal('t')}, ' ')) || ' ' AS x FROM (SELECT email_id, {_COMBINED} AS t FROM fr)),
terms AS (SELECT email_id, block, unnest(w) AS term FROM words
  UNION ALL SELECT email_id, block, unnest(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL SELECT email_id, 'combined_char', unnest(list_transform(range(1, greatest(length(x) - n + 2, 1)), lambda i: substr(x, CAST(i AS INTEGER), n)))
    FROM padded, (VALUES (3), (4), (5)) s(n) WHERE length(x) >= 3)"""
_STATS = "stats AS (SELECT block, term, count(*) AS tf, count(DISTINCT email_id) AS df FROM terms GROUP BY ALL)"
_SIZES = "CASE block " + " ".join(f"WHEN '{b.name}' THEN {b.size}" for b in T.BLOCKS) + " END"
_VOCAB = f"vocab AS (SELECT * FROM stats WHERE df >= 2 QUALIFY row_number() OVER (PARTITION BY block ORDER BY tf DESC, term) <= {_SIZES})"
_TFIDF = """tfidf AS (SELECT email_id, block, term, w / sqrt(sum(w * w) OVER (PARTITION BY email_id, block)) AS weight FROM (
  SELECT email_id, block, term, (1 + ln(count(*))) * (ln((1 + (SELECT count(*) FROM emails)) / (1 + any_value(df))) + 1) AS w
  FROM terms JOIN vocab USING (block, term) GROUP BY email_id, block, term))"""


def _terms(spark, sf):
    """email_id and the three term columns, written once for their readers."""
    return S.staged_table(TR.term_table(_mails(spark, sf), ["email_id"]), "terms")


def _texts(spark, sf):
    """email_id and the texts that terms are cut from, written once for their readers."""
    return S.staged_table(TR.feature_table(_mails(spark, sf), ["email_id"]).select("email_id", *[b.text for b in T.BLOCKS]), "texts")


@query(E("SELECT * FROM stats", *_FEATS, _TERMS, _STATS))
def term_frequencies(spark, sf):
    return T.block_stats(TR.feature_table(_mails(spark, sf), ["email_id"]))


@query(E("SELECT * FROM vocab", *_FEATS, _TERMS, _STATS, _VOCAB))
def vocabulary(spark, sf):
    return T.block_vocabularies(_texts(spark, sf))


@query(E("SELECT email_id, block, term, round(weight, 6) AS weight FROM tfidf", *_FEATS, _TERMS, _STATS, _VOCAB, _TFIDF))
def tfidf_weights(spark, sf):
    rows = _texts(spark, sf)
    kept = T.block_vocabularies(rows).collect()  # bounded by the term caps
    n, out = _mails(spark, sf).count(), None
    for block in T.BLOCKS:
        found = T.tfidf_rows(rows, block, "email_id", [r for r in kept if r["block"] == block.name], n).select(
            "email_id", F.lit(block.name).alias("block"), "term", F.round("weight", 6).alias("weight"))
        out = found if out is None else out.unionByName(found)
    return out


@query(E("SELECT term, tf, df FROM stats WHERE block = 'combined_char'", *_FEATS, _TERMS, _STATS))
def character_ngrams(spark, sf):
    return NG.gram_stats(TR.feature_table(_mails(spark, sf), ["email_id"]), {}, T.CHAR_BLOCKS).drop("block")


@query(E(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END, 6) AS std
        FROM feats""" for c in K.NUMERIC_COLUMNS), *_FEATS))
def feature_scaling(spark, sf):
    frame = FE.training_features(_mails(spark, sf))
    return M.scaling(frame).select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(E("""SELECT label, count(*) AS n, round((SELECT count(*) FROM emails) / (2 * count(*)), 9) AS weight FROM emails GROUP BY label"""))
def class_weights(spark, sf):
    return M.class_weights(_mails(spark, sf)).withColumn("weight", F.round("weight", 9))


@query(E("SELECT email_id, CAST(CASE WHEN p >= 0.42 THEN 1 ELSE 0 END AS INTEGER) AS predicted FROM scored", _SCORED))
def threshold_labels(spark, sf):
    return _scored(spark, sf).select("email_id", M.classify(F.col("p")).alias("predicted"))


@query(E(f"""SELECT email_id, CASE WHEN c AND p >= 0.42 THEN 'Spam' ELSE 'Safe' END AS model_prediction,
  round_even(CASE WHEN c THEN p ELSE 0 END, 4) AS model_probability, round_even(CASE WHEN c THEN p ELSE 0 END * 100, 1) AS model_score,
  CASE WHEN c THEN round_even(greatest(p, 1 - p), 4) ELSE 0 END AS model_confidence
  FROM (SELECT email_id, {_CONTENT} <> '' AS c, p FROM blanked)""", _BLANKED))
def model_output(spark, sf):
    m = _blanked(spark, sf)
    return S.model_columns(m, "p", FE.has_content(m)).select(
        "email_id", "model_prediction", "model_probability", "model_score", "model_confidence")


_READ = rf"trim(regexp_replace(replace(value, '_', ' '), '\s+', ' ', 'g'))"
_CONTRIB = f"""contrib AS (SELECT email_id, block AS source, replace(term, ' ', '_') AS value, ((email_id + length(term) * 7) % 11 - 4) / 8 AS contribution
  FROM (SELECT DISTINCT email_id, block, term FROM terms)),
named AS (SELECT *, CASE WHEN length(v) >= 3 AND regexp_matches(v, '[A-Za-z]') AND v NOT IN {Q.in_list(K.GENERIC_TOKENS)} THEN
    CASE source WHEN 'subject_word' THEN 'Subject mentions "' || v || '"' WHEN 'body_word' THEN 'Body contains "' || v || '"' END END AS reason
  FROM (SELECT *, {_READ} AS v FROM contrib))"""


@query(E("SELECT DISTINCT source, value, reason FROM named", *_FEATS, _TERMS, _CONTRIB))
def feature_reasons(spark, sf):
    stats = T.block_stats(TR.feature_table(_mails(spark, sf), ["email_id"]))  # counted in the tasks: no term of a mail is shuffled by itself
    rows = stats.select(F.col("block").alias("source"), F.replace("term", F.lit(" "), F.lit("_")).alias("value")).distinct()
    return rows.select("source", "value", EX.readable_reason(F.col("source"), F.col("value")).alias("reason"))


@query(E("""SELECT email_id, reason, round_even(impact, 4) AS impact, CAST(place AS INTEGER) AS place FROM (
  SELECT email_id, reason, max(contribution) AS impact, row_number() OVER (PARTITION BY email_id ORDER BY max(contribution) DESC, reason) AS place
  FROM named WHERE contribution > 0 AND reason IS NOT NULL GROUP BY email_id, reason) WHERE place <= 5""", *_FEATS, _TERMS, _CONTRIB))
def top_reasons(spark, sf):
    # no sentence names a character n-gram, so the mails are cut into words and word pairs only
    mails = FE.training_features(_mails(spark, sf))
    words = LU.computed_once(mails, **{b.terms: T.with_pairs(T.word_terms(F.col(f"{b.text.removesuffix('_words')}_text"))) for b in T.BLOCKS if b.words})

    def contributions(block):
        return F.transform(F.array_distinct(block.terms), lambda t: F.struct(
            F.lit(block.name).alias("source"), F.replace(t, F.lit(" "), F.lit("_")).alias("value"),
            (((F.col("email_id") + F.length(t) * 7) % 11 - 4) / 8).alias("contribution")))

    return EX.top_reason_rows(words.select("email_id", F.concat(*[contributions(b) for b in T.BLOCKS if b.words]).alias("contributions")))


def _model(spark, sf):
    """Trained, saved and published by the first query that asks, loaded by the others."""
    table = hashlib.md5(sf.encode()).hexdigest()
    return TR.train_or_load(spark, f"{staging_dir(spark)}/checks-model-{spark.sparkContext.applicationId}-{table}", _mails(spark, sf))


# a coefficient for every term and numeric feature, by a formula that both sides know
_COEF = "((length({0}) * 7 + ascii({0})) % 11 - 5) / 10"
_CONTRIBUTIONS = f"""scaling AS (SELECT c AS feature, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1 ELSE stddev_pop(x) END AS std FROM numbers GROUP BY c),
impacts AS (SELECT email_id, block AS source, term AS value, weight * {_COEF.format('term')} AS contribution FROM tfidf
  UNION ALL SELECT email_id, 'numeric', c, (x - mean) / std * {_COEF.format('c')} FROM numbers JOIN scaling ON feature = c)"""
_NUMBERS = "numbers AS (SELECT email_id, c, x FROM feats UNPIVOT (x FOR c IN (" + ", ".join(K.NUMERIC_COLUMNS) + ")))"
_MODEL = (*_FEATS, _TERMS, _STATS, _VOCAB, _TFIDF, _NUMBERS, _CONTRIBUTIONS)


def _vectors(spark, sf):
    """(feature names, mails with their vectors) by the stages that training fits, over all mails."""
    rows = S.staged_table(TR.feature_table(_mails(spark, sf), ["email_id"]), "features")
    stages, made = TR.feature_stages(spark, rows)
    for stage in stages:
        rows = stage.transform(rows)
    return made.feature_names, rows.select("email_id", "features")


def _impacts(spark, sf):
    """Feature names; email_id and the products of value and coefficient other than 0, by feature position."""
    names, rows = _vectors(spark, sf)
    coefficients = [((len(v) * 7 + ord(v[0])) % 11 - 5) / 10 for _, v in names]
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(coefficients), inputCol="features", outputCol="impact")
    return names, scaled.transform(rows).select("email_id", TR.vector_entries("impact").alias("impact"))


@query(E("SELECT email_id, round(1 / (1 + exp(-sum(contribution))), 6) AS p FROM impacts GROUP BY email_id", *_MODEL))
def logit_scores(spark, sf):
    _, rows = _impacts(spark, sf)
    total = F.aggregate("impact", F.lit(0.0), lambda a, x: a + x["x"])
    return rows.select("email_id", F.round(1 / (1 + F.exp(-total)), 6).alias("p"))


@query(E("SELECT email_id, source, value, round(contribution, 6) AS contribution FROM impacts WHERE abs(contribution) > 1e-9", *_MODEL))
def feature_contributions(spark, sf):
    names, rows = _impacts(spark, sf)
    named = spark.createDataFrame([(i, s, v) for i, (s, v) in enumerate(names)], "i int, source string, value string")
    found = rows.select("email_id", F.inline("impact")).where(F.abs("x") > 1e-9)
    return found.join(F.broadcast(named), "i").select("email_id", "source", "value", F.round("x", 6).alias("contribution"))


_SPLIT_SQL = """held AS (SELECT email_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(email_id || ':42'), email_id)
  <= round(0.2 * count(*) OVER (PARTITION BY label)) AS is_test FROM emails),
training AS (SELECT email_id, label FROM held WHERE NOT is_test)"""


@query(E(f"""SELECT (SELECT count(*) FROM emails) AS training_rows, (SELECT CAST(sum(least(n, {_SIZES})) AS BIGINT) + {len(K.NUMERIC_COLUMNS)}
    FROM (SELECT block, count(*) AS n FROM (SELECT block, term FROM terms JOIN training USING (email_id)
      GROUP BY block, term HAVING count(DISTINCT email_id) >= 2) GROUP BY block)) AS feature_count,
  round((SELECT count(*) FROM training) / (2 * count(*) FILTER (label = 0)), 9) AS weight_ham,
  round((SELECT count(*) FROM training) / (2 * count(*) FILTER (label = 1)), 9) AS weight_spam FROM training""", *_FEATS, _TERMS, _SPLIT_SQL))
def training_summary(spark, sf):
    mails = _mails(spark, sf)
    split = O.stratified_split(mails, "email_id", "label")
    rows = S.staged_table(TR.feature_table(split, ["email_id", "label", "is_test"]), "features")
    train = rows.where(~F.col("is_test"))
    kept = T.block_vocabularies(train).agg(F.count("*")).scalar()
    weight = {r["label"]: r["weight"] for r in M.class_weights(train).collect()}
    return rows.agg(F.count("*").alias("training_rows")).select(
        "training_rows", (kept + len(K.NUMERIC_COLUMNS)).cast("long").alias("feature_count"),
        F.round(F.lit(weight[0]), 9).alias("weight_ham"), F.round(F.lit(weight[1]), 9).alias("weight_spam"))


_KEPT = """kept AS (SELECT block AS source, term AS value FROM (SELECT block, term, count(*) AS tf, count(DISTINCT email_id) AS df
    FROM terms JOIN training USING (email_id) GROUP BY block, term) WHERE df >= 2
  QUALIFY row_number() OVER (PARTITION BY block ORDER BY tf DESC, term) <= """ + _SIZES + ")"


@query(E(f"""SELECT source, value, TRUE AS at_optimum FROM kept UNION ALL SELECT 'numeric', unnest([{", ".join(f"'{c}'" for c in K.NUMERIC_COLUMNS)}]), TRUE
  UNION ALL SELECT 'intercept', '', TRUE""", *_FEATS, _TERMS, _SPLIT_SQL, _KEPT))
def model_optimum(spark, sf):
    """Every feature of the fitted model, and whether the slope of the penalised loss, summed over the training mails,
    vanishes there up to the tolerance.  The oracle knows the features and that an optimum has no slope."""
    mails, fitted = _mails(spark, sf), _model(spark, sf)
    split = O.stratified_split(mails, "email_id", "label")
    train = TR.feature_table(split.where(~F.col("is_test")), ["label"])
    weighted = train.join(F.broadcast(M.class_weights(train).select("label", "weight")), "label")
    for stage in fitted.model.stages[:-1]:
        weighted = stage.transform(weighted)
    slopes, intercept = TR.gradient(fitted, S.staged_table(weighted.select("label", "weight", "features"), "vectors"))
    rows = [(*name, bool(abs(g) <= K.GRADIENT_TOLERANCE)) for name, g in zip(fitted.feature_names, slopes)]
    return spark.createDataFrame([*rows, ("intercept", "", bool(abs(intercept) <= K.GRADIENT_TOLERANCE))], "source string, value string, at_optimum boolean")


@query()
def trained_model_metrics(spark, sf):
    m = _model(spark, sf).metrics
    return spark.createDataFrame([tuple(float(m[k]) for k in ("accuracy", "precision", "recall", "f1", "roc_auc"))
                                  + (int(m["training_rows"]), int(m["feature_count"]))],
                                 "accuracy double, precision double, recall double, f1 double, roc_auc double, "
                                 "training_rows long, feature_count long")


@query()
def model_indicators(spark, sf):
    fitted = _model(spark, sf)
    applied = TR.apply(fitted, _mails(spark, sf))
    rows = TR.explain(fitted, applied).select("email_id", F.posexplode("model_indicators").alias("pos", "i"))
    return rows.select("email_id", "pos", "i.reason", "i.impact")


# --- verdicts ------------------------------------------------------------------------------------

def _requests(spark, sf):
    m = C.with_probability(_mails(spark, sf))
    url = F.coalesce(F.substring_index("urls", ",", 1), F.lit(""))
    return m.withColumn("url", url).drop("urls")


def _verdicts(spark, sf):
    return S.score_mails(_requests(spark, sf), C.trusted_deck(spark, sf), C.safe_deck(spark, sf),
                         D.reputation(_mails(spark, sf), SUF), suffixes=SUF)


def _pairs(c):
    return F.array_join(F.transform(c, lambda e: F.concat_ws(":", e["distance"], e["closest"])), "|")


def _looks(c="lookalikes"):
    return F.array_join(F.transform(c, lambda e: F.concat_ws(":", e["source"], e["distance"], e["closest"])), "|")


_LINK_COLS = ("urls", "url_status", "url_check", "edit_check", "suspicious_urls", "neutral_urls", "lookalikes")


@query(E("SELECT email_id, " + ", ".join(f"coalesce({c}, '') AS {c}" for c in _LINK_COLS) + " FROM per_mail",
         Q.REQUESTS, Q.HOSTS, Q.LINKS, Q.facts("links"), Q.CHECKED))
def mail_link_results(spark, sf):
    req = S.mail_requests(_requests(spark, sf), "email_id")
    links = S.staged_table(S.mail_links(req, "email_id", SUF), "mail-links")
    r = S.link_results(links, "email_id", C.trusted_deck(spark, sf), C.safe_deck(spark, sf), SUF)
    return r.select("email_id", bars("urls").alias("urls"), bars("url_status").alias("url_status"),
                    F.array_join(F.col("url_check").cast("array<string>"), "|").alias("url_check"),
                    _pairs("edit_check").alias("edit_check"), bars("suspicious_urls").alias("suspicious_urls"),
                    bars("neutral_urls").alias("neutral_urls"), _looks().alias("lookalikes"))


@query(E("""SELECT email_id, string_agg(d, '|' ORDER BY pos) AS links FROM (SELECT email_id, d, min(pos) AS pos FROM cand WHERE d <> '' GROUP BY ALL)
            GROUP BY email_id""", Q.REQUESTS, Q.LINKS))
def mail_raw_links(spark, sf):
    req = S.mail_requests(_requests(spark, sf), "email_id")
    return req.select("email_id", bars(S.raw_links(F.col("body"), F.col("url"), SUF)).alias("links")).where("links <> ''")


@query(Q.verdict("""SELECT email_id, f_model, f_keyword, f_url, f_look, f_sender, CAST(spam_votes AS INTEGER) AS spam_votes FROM verdict"""))
def risk_flags(spark, sf):
    f = F.col("check_flags")
    return _verdicts(spark, sf).select(
        "email_id", f["trained_model"].alias("f_model"), f["keyword_scan"].alias("f_keyword"), f["url_safety"].alias("f_url"),
        f["lookalike_domains"].alias("f_look"), f["sender_domain"].alias("f_sender"), "spam_votes")


_REASON_SQL = f"""list_filter([
  CASE WHEN model_probability >= 0.7 THEN 'The trained model found a strong phishing match (' || CAST(model_score AS DOUBLE) || '% phishing likelihood).'
       WHEN model_probability >= 0.42 THEN 'The trained model leaned toward phishing (' || CAST(model_score AS DOUBLE) || '% phishing likelihood).' END,
  CASE WHEN keyword_score >= 50 AND keywords <> '' THEN 'Suspicious wording detected: ' || {Q.top('keywords', 5)} || '.' END,
  CASE WHEN f_url THEN 'High-risk URL or domain found: ' || {Q.top('suspicious_urls', 3)} || '.' END,
  CASE WHEN f_look THEN 'Lookalike domain detected: "' || first_look.u || '" is close to trusted site "' || first_look.c || '" (distance ' || first_look.d || ').' END,
  CASE WHEN f_sender THEN 'Sender domain ' || sender_host || ' is marked as ' || sender_category || '.'
       WHEN lower(sender_category) IN ('uncertain', 'unknown') THEN 'Sender domain ' || sender_host || ' is not strongly trusted in the domain dataset.' END
], lambda k: k IS NOT NULL)"""
_REASONS = f"""CASE WHEN len({_REASON_SQL}) = 0 AND final_label = 'Safe'
  THEN 'No strong phishing wording, link issues, or sender-domain risks were found.' ELSE array_to_string({_REASON_SQL}, '|') END"""
_SENDER_STATUS = """CASE WHEN lower(sender_category) IN ('spam', 'suspicious') THEN 'Suspicious'
  WHEN lower(sender_category) IN ('uncertain', 'not found', 'unknown') THEN 'Unknown' ELSE 'Trusted' END"""


@query(Q.verdict(f"SELECT email_id, {_REASONS} AS reasons FROM verdict"))
def risk_reasons(spark, sf):
    return _verdicts(spark, sf).select("email_id", bars("reasons").alias("reasons"))


_CHECKS = f"""SELECT email_id, 'Trained Model' AS name, CASE WHEN f_model THEN 'Suspicious' ELSE 'Clear' END AS status,
   CAST(model_score AS DOUBLE) || '% phishing probability.' AS detail FROM verdict
UNION ALL SELECT email_id, 'Keyword Scan', CASE WHEN f_keyword THEN 'Suspicious' ELSE 'Clear' END, CASE WHEN keywords <> ''
   THEN 'Score ' || CAST(keyword_score AS DOUBLE) || ' with keywords: ' || {Q.top('keywords', 4)} || '.'
   ELSE 'Score ' || CAST(keyword_score AS DOUBLE) || ' with no strong keyword hits.' END FROM verdict
UNION ALL SELECT email_id, 'URL Safety', CASE WHEN f_url THEN 'Suspicious' WHEN neutral_urls <> '' THEN 'Neutral' ELSE 'Clear' END,
   CASE WHEN f_url THEN 'High-risk links found: ' || {Q.top('suspicious_urls', 3)} || '.'
        WHEN neutral_urls <> '' THEN 'Links looked normal or matched the sender domain: ' || {Q.top('neutral_urls', 3)} || '.'
        ELSE 'No high-risk links were found.' END FROM verdict
UNION ALL SELECT email_id, 'Lookalike Domains', CASE WHEN f_look THEN 'Suspicious' ELSE 'Clear' END,
   CASE WHEN f_look THEN first_look.u || ' is similar to ' || first_look.c || '.' ELSE 'No close impersonation domains were detected.' END FROM verdict
UNION ALL SELECT email_id, 'Sender Domain', {_SENDER_STATUS}, CASE {_SENDER_STATUS} WHEN 'Suspicious' THEN 'Sender domain is marked as ' || sender_category || '.'
   WHEN 'Unknown' THEN 'Sender domain was not strongly verified in the domain dataset.' ELSE 'Sender domain matched a known legitimate domain.' END FROM verdict"""


@query(Q.verdict(_CHECKS))
def risk_checks(spark, sf):
    return _verdicts(spark, sf).select("email_id", F.inline("checks_breakdown"))


_VERDICT_COLS = ["email_id", "final_label", "overall_score", "risk_level", "spam_votes", "sender_host", "sender_category", "keyword_score",
                 "keyword_label", "keywords", "urls", "url_check", "url_status", "edit_check", "lookalikes", "model_prediction",
                 "model_probability", "model_score", "model_confidence", "reasons", "verdict_message"]


_VERDICT_SQL = Q.verdict("SELECT " + ", ".join({
    "spam_votes": "CAST(spam_votes AS INTEGER) AS spam_votes", "reasons": f"{_REASONS} AS reasons",
    "keyword_label": "CASE WHEN keyword_score >= 50 THEN 'Spam' ELSE 'Safe' END AS keyword_label",
    "overall_score": "CAST(overall_score AS DOUBLE) AS overall_score"}.get(c, c) for c in _VERDICT_COLS) + " FROM verdict")


def _flat_verdicts(v):
    return v.withColumns({
        "keywords": bars("keywords"), "urls": bars("urls"), "url_status": bars("url_status"), "reasons": bars("reasons"),
        "url_check": F.array_join(F.col("url_check").cast("array<string>"), "|"), "edit_check": _pairs("edit_check"),
        "lookalikes": _looks()}).select(*_VERDICT_COLS)


@query(_VERDICT_SQL)
def risk_verdicts(spark, sf):
    return _flat_verdicts(_verdicts(spark, sf))


@query(_VERDICT_SQL)
def verdicts_without_ids(spark, sf):
    """Ids are null for a third of the mails and shared by another third; links and probabilities must stay
    with their mail.  The true id travels in a carried column."""
    n = F.col("email_id")
    m = _requests(spark, sf).withColumn("id", F.when(n % 3 == 1, n).when(n % 3 == 2, F.lit(7)))
    v = S.score_mails(m, C.trusted_deck(spark, sf), C.safe_deck(spark, sf), D.reputation(_mails(spark, sf), SUF), key="id",
                      suffixes=SUF, carry=["email_id"])
    return _flat_verdicts(v)


@query(Q.verdict("SELECT DISTINCT sender_category, " + _SENDER_STATUS + " AS status FROM verdict"))
def sender_statuses(spark, sf):
    m = _mails(spark, sf)
    rows = SE.sender_reputation(m.select("email_id", "from"), D.reputation(m, SUF))
    return rows.select("sender_category", S.sender_status(F.col("sender_category")).alias("status")).distinct()


@query(_VERDICT_SQL)
def verdict_json(spark, sf):
    """The whole record written as JSON and read back."""
    v = _verdicts(spark, sf)
    written = SK.as_json(v, "email_id")
    return _flat_verdicts(written.select(F.from_json("json", v.schema).alias("v")).select("v.*"))


@query(E("""SELECT email_id, 'not a JSON object: ' || body AS error, 'Error' AS final_label, CAST(0 AS DOUBLE) AS overall_score,
  'Unknown' AS risk_level, CAST(0 AS INTEGER) AS spam_votes, 'Error' AS model_prediction FROM emails WHERE "from" = 'not-an-email'"""))
def error_records(spark, sf):
    m = _mails(spark, sf).select(
        F.col("email_id").alias("id"), F.when(F.col("from") == "not-an-email", F.col("body")).alias("_corrupt"), "from", "body")
    return PS.split_requests(m)[1].select(F.col("id").alias("email_id"), "error", "final_label", "overall_score", "risk_level",
                                          "spam_votes", "model_prediction")


@query(E("SELECT email_id AS id, subject, body, \"from\", urls FROM emails"))
def mail_json_round_trip(spark, sf):
    path = _scratch(spark, "requests")
    m = _mails(spark, sf).select(F.col("email_id").alias("id"), "subject", "body", "from", "urls")
    m.write.json(path)
    return FS.mail_requests_json(spark, path).where("_corrupt is null").select(
        F.col("id").cast("long").alias("id"), "subject", "body", "from", "urls")
