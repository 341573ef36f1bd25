"""SQL building blocks of the oracle queries (DuckDB dialect)."""

from mailtriage import constants as K
from checks.corpus import CORPUS_SUFFIXES, LINK_DECK, PHRASE_DECK

W = r"[\p{L}\p{N}_]"      # a word character
NW = r"[^\p{L}\p{N}_]"


def q(text):
    return "NULL" if text is None else "'" + str(text).replace("'", "''") + "'"


def values(rows):
    return "(VALUES " + ", ".join(
        "(" + ", ".join(q(x) if isinstance(x, (str, type(None))) else str(x) for x in r) + ")" for r in rows) + ")"


def in_list(items):
    return "(" + ", ".join(map(q, items)) + ")"


def ctes(*parts, final):
    return "WITH " + ",\n".join(parts) + "\n" + final


_ADDRESS = "regexp_extract(d.text, '[a-z]+[.][0-9]+@[a-z0-9]+[.]example[.]com', 0)"
EMAILS = f"""emails AS (
  SELECT d.doc_id AS email_id,
    CASE WHEN d.doc_id % 10 = 5 THEN 'nan'
         ELSE concat_ws(' ', ph.s, split_part(d.text, chr(10), 1)) END AS subject,
    concat_ws(' ', d.text, nullif(ph.b, ''), CASE WHEN d.doc_id % 2 = 0 THEN g.url END, lk.u) AS body,
    CASE WHEN {_ADDRESS} <> '' THEN 'Doc <' || {_ADDRESS} || '>'
         WHEN d.doc_id % 4 = 0 THEN 'User ' || d.doc_id || ' <u' || d.doc_id || '@'
              || regexp_extract(g.url, '^https?://([^/:?#]+)', 1) || '>'
         WHEN d.doc_id % 4 = 1 THEN 'u' || d.doc_id || '@rooms-office.com'
         WHEN d.doc_id % 4 = 2 THEN 'not-an-email' ELSE 'alerts@gmail.com' END AS "from",
    d.source || '@inbox.example.org' AS "to",
    nullif(concat_ws(', ', CASE WHEN d.doc_id % 2 = 0 THEN g.url END, lk.u), '') AS urls,
    CAST(coalesce(b.toxic, CASE WHEN d.doc_id % 10 IN (0, 2, 4, 6) THEN 1 ELSE 0 END) AS INTEGER) AS label,
    d.lang AS lang
  FROM documents d
  LEFT JOIN pages g ON g.page_id = d.doc_id % (SELECT count(*) FROM pages)
  LEFT JOIN labels b ON b.doc_id = d.doc_id
  LEFT JOIN {values([(k, s, b) for k, (s, b) in PHRASE_DECK.items()])} ph(slot, s, b) ON ph.slot = d.doc_id % 10
  LEFT JOIN {values(list(enumerate(LINK_DECK)))} lk(slot, u) ON lk.slot = d.doc_id % 11
)"""

RAW = """raw AS (
  SELECT email_id * 2 + copy AS email_id, label,
    concat_ws(chr(10), 'Message-ID: <m' || email_id || '@mail.example.org>',
      'Date: Tue, 08 Apr 2025 09:15:00 +0800', 'From: ' || "from", 'To: ' || "to",
      'Subject: ' || CASE WHEN email_id % 13 = 0 THEN '' WHEN email_id % 4 = 1
                          THEN subject || chr(10) || ' folded tail' ELSE subject END,
      CASE WHEN email_id % 3 = 0 THEN 'Sender: ' || "to" END,
      CASE WHEN email_id % 5 = 0 THEN 'List-Id: news ' || (email_id % 3) || ' <list.example.org>' END,
      'X-Loop: a')
    || CASE WHEN email_id % 23 = 5 THEN chr(10) || 'Content-Type: multipart/mixed; boundary="sep-' || email_id || '"' || chr(10) || chr(10) || 'no text'
         || chr(10) || '--sep-' || email_id || chr(10) || 'Content-Type: text/plain; charset=utf-8' || chr(10) || 'Content-Transfer-Encoding: base64'
         || chr(10) || chr(10) || to_base64(encode(content)) || chr(10) || '--sep-' || email_id || chr(10) || 'Content-Type: text/html' || chr(10)
         || 'Content-Transfer-Encoding: quoted-printable' || chr(10) || chr(10) || 'caf=C3=A9 soft=' || chr(10) || 'line 100% =3D ' || email_id
         || chr(10) || '--sep-' || email_id || chr(10) || 'Content-Type: application/pdf' || chr(10) || 'Content-Disposition: attachment' || chr(10) || chr(10)
         || 'QUJD' || chr(10) || '--sep-' || email_id || '--' || chr(10)
       ELSE chr(10) || chr(10) || content END AS message,
    CASE WHEN email_id % 23 = 5 THEN content || chr(10) || chr(10) || 'café softline 100% = ' || email_id END AS parts
  FROM (SELECT *, CASE WHEN email_id % 13 = 0 THEN 'Subject: recovered ' || email_id || chr(10) || chr(9)
            || 'second line' || chr(10) || 'X-Mailer: one' || chr(10) || 'Subject: again ' || email_id
            || chr(10) || chr(10) ELSE '' END
    || body
    || CASE WHEN email_id % 9 = 0 THEN chr(10) || 'X-Tag: t' || email_id || chr(10) || 'end' ELSE '' END
    AS content FROM emails), (VALUES (0), (1)) c(copy) WHERE copy = 0 OR email_id % 7 = 0
)"""

_ALT = "|".join(s.replace(".", "[.]") for s in sorted(CORPUS_SUFFIXES, key=len, reverse=True))


def bare(h):
    h = f"regexp_replace({h}, '[/?#].*$', '', 's')"
    return f"rtrim(regexp_replace(regexp_replace({h}, '^.*@', '', 's'), ':.*$', '', 's'), '.')"


def reg(h):
    """Registrable domain of a host expression."""
    return (f"coalesce(nullif(regexp_extract({bare(f'lower({h})')}, "
            f"'(?:^|[.])([^.]+[.](?:{_ALT}))$', 1), ''), lower({h}))")


def text_hosts(c):
    return (rf"list_concat(regexp_extract_all(coalesce({c}, ''), '(?i)https?://([^/\s,]+)', 1), "
            rf"regexp_extract_all(coalesce({c}, ''), '[\p{{L}}\p{{N}}_.-]+@([\p{{L}}\p{{N}}_.-]+\.[\p{{L}}\p{{N}}_]+)', 1))")


def strip(c):
    return f"trim({c}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def squeeze(c):
    return rf"{strip(rf"regexp_replace({c}, '\s+', ' ', 'g')")}"


def clean(c):
    s = strip(f"coalesce({c}, '')")
    return f"CASE WHEN lower({s}) IN {in_list(K.PLACEHOLDER_VALUES)} THEN '' ELSE {s} END"


def normal(c):
    return squeeze(f"lower(coalesce({c}, ''))")


def corpus_clean(c, keep_tags=False):
    t = c if keep_tags else f"regexp_replace({c}, '<[^>]*>', '', 'g')"
    t = f"regexp_replace({t}, '[-*]{{4,}}', ' ', 'g')"
    t = f"translate({t}, '[]''\"', '')"
    return squeeze(t)


# --- reputation --------------------------------------------------------------------

def reputation(source="emails"):
    lists = ", ".join(text_hosts(c) for c in ("urls", "body", '"from"', '"to"'))
    legit = " OR ".join(f"contains(domain, {q(w)})" for w in K.KNOWN_LEGIT_DOMAINS)
    spam = " OR ".join(f"contains(domain, {q(w)})" for w in K.SPAM_DOMAIN_MARKS)
    return f"""seen AS (
  SELECT DISTINCT email_id, label, "from" AS f, urls AS u, {reg('h')} AS domain
  FROM (SELECT *, unnest(list_concat({lists})) AS h FROM {source})
), counted AS (
  SELECT domain, count(*) AS n, count(*) FILTER (label = 1) AS sp, count(*) FILTER (label <> 1) AS ha,
    concat_ws(', ', CASE WHEN bool_or(contains(f, domain)) THEN 'from' END,
                    CASE WHEN bool_or(coalesce(contains(u, domain), false)) THEN 'urls' END) AS sources
  FROM seen WHERE domain <> '' GROUP BY domain
), rep AS (
  SELECT domain, CAST(greatest(0, least(100, 50
      + CASE WHEN {legit} THEN 40 ELSE 0 END - CASE WHEN {spam} THEN 30 ELSE 0 END
      + CASE WHEN ha > sp THEN 25 WHEN sp > ha THEN -25 ELSE 0 END
      - CASE WHEN n = 1 AND sp = 1 THEN 20 ELSE 0 END
      + CASE WHEN regexp_matches(domain, '[.](org|edu|gov)$') THEN 15 ELSE 0 END
      + CASE WHEN regexp_matches(domain, '[.](com|net)$') AND ha > 0 THEN 5 ELSE 0 END)) AS INTEGER) AS legitimacy_score,
    n AS total_occurrences, sp AS in_spam, ha AS in_ham, sources
  FROM counted
), reputation AS (
  SELECT *, CASE WHEN legitimacy_score >= 70 THEN 'legitimate' WHEN legitimacy_score >= 40 THEN 'uncertain'
                 ELSE 'spam' END AS category FROM rep
)"""


def mailbox_host(c):
    return (f"lower({strip(f'''split_part(regexp_replace(coalesce(nullif(regexp_extract({c}, '<([^<>]*)>', 1), ''), {c}), '^[^@]*$', ''), '@', 2)''')})")


def sender(source, host):
    """found(email_id, sender_* columns) of a source with that host expression."""
    return f"""hosts AS (SELECT *, {host} AS host FROM {source}),
found AS (
  SELECT h.email_id,
    CASE WHEN host = '' THEN 'Not Found' ELSE coalesce(r.domain, host) END AS sender_host,
    CASE WHEN host = '' THEN 'Not Found' ELSE coalesce(r.sources, 'none') END AS sender_sources,
    CASE WHEN host = '' THEN 'Not Found' WHEN r.domain IS NULL THEN 'unknown'
         WHEN r.total_occurrences <= 5 AND r.legitimacy_score < 90 THEN 'suspicious'
         ELSE r.category END AS sender_category,
    CASE WHEN host = '' THEN 'not_found' WHEN r.domain IS NULL THEN 'unknown' ELSE 'matched' END AS lookup_status,
    CASE WHEN host <> '' THEN coalesce(r.legitimacy_score, 0) END AS sender_score,
    CASE WHEN host <> '' THEN coalesce(r.total_occurrences, 0) END AS sender_occurrences,
    CASE WHEN host <> '' THEN coalesce(r.in_spam, 0) END AS sender_in_spam,
    CASE WHEN host <> '' THEN coalesce(r.in_ham, 0) END AS sender_in_ham
  FROM hosts h LEFT JOIN reputation r ON r.domain = h.host
)"""


# --- lexicon ---------------------------------------------------------------------

def lexicon(source="emails"):
    counted = " UNION ALL ".join(
        f"SELECT email_id, {q(p)} AS phrase, {w} AS pw, len(regexp_extract_all(dt, "
        f"'(?:^|{NW}){p.replace(' ', '  ')}(?:$|{NW})')) AS hits FROM doubled" for p, w in K.PHRASE_WEIGHTS.items())
    return f"""weights(term, w) AS {values(list(K.KEYWORD_WEIGHTS.items()))},
texts AS (SELECT email_id, subject, body, {strip(f"{normal('subject')} || ' ' || {normal('body')}")} AS t FROM {source}),
runs AS (
  SELECT email_id, 1 AS s, 0 AS b, unnest(regexp_extract_all(lower(coalesce(subject, '')), '{W}+')) AS term FROM texts
  UNION ALL
  SELECT email_id, 0, 1, unnest(regexp_extract_all(lower(coalesce(body, '')), '{W}+')) FROM texts
), kw AS (
  SELECT email_id, term, w, sum(s) AS s, sum(b) AS b FROM runs JOIN weights USING (term) GROUP BY ALL
), doubled AS MATERIALIZED (SELECT email_id, regexp_replace(t, '({NW})', '\\1\\1', 'g') AS dt FROM texts),
ph AS (SELECT * FROM ({counted}) WHERE hits > 0), matched AS (
  SELECT email_id, term FROM kw
  UNION SELECT email_id, unnest(string_split(phrase, ' ')) FROM ph
), lex_words AS (
  SELECT m.email_id, m.term FROM matched m JOIN weights USING (term)
), toks AS (
  SELECT email_id, unnest(x) AS tok, generate_subscripts(x, 1) AS pos
  FROM (SELECT email_id, list_transform(regexp_extract_all(t, '[A-Za-z][A-Za-z''-]{{2,}}'),
                                        lambda k: trim(lower(k), '''')) AS x FROM texts)
), ordered AS (
  SELECT w.email_id, w.term, min(pos) AS pos FROM lex_words w
  LEFT JOIN toks k ON k.email_id = w.email_id AND k.tok = w.term GROUP BY ALL
), bonus AS (
  SELECT email_id, count(*) AS n, string_agg(term, '|' ORDER BY pos NULLS LAST, term) AS matched,
    string_agg(term, '|' ORDER BY term) AS keywords,
    least(360, 35 * count(*))
      + CASE WHEN count(*) FILTER (term IN {in_list(K.ADULT_CLUSTER)}) >= 3 THEN 300 ELSE 0 END
      + CASE WHEN count(*) FILTER (term IN {in_list(K.PHISHING_CLUSTER)}) >= 3 THEN 240 ELSE 0 END AS x
  FROM ordered GROUP BY email_id
), kp AS (SELECT email_id, sum(20 * w + CASE WHEN s > 0 THEN 7 * w ELSE 0 END
                               + greatest(0, least(7 * w, 3 * w * (b - 1)))) AS k FROM kw GROUP BY email_id),
pp AS (SELECT email_id, sum(20 * pw * least(2, hits)) AS p FROM ph GROUP BY email_id),
lex AS (
  SELECT t.email_id, coalesce(k, 0) / 20 AS keyword_part, coalesce(pp.p, 0) / 20 AS phrase_part,
    coalesce(x, 0) / 20 AS bonus_part,
    least(2000, coalesce(k, 0) + coalesce(pp.p, 0) + coalesce(x, 0)) / 20 AS keyword_score,
    coalesce(matched, '') AS matched, coalesce(keywords, '') AS keywords
  FROM texts t LEFT JOIN kp USING (email_id) LEFT JOIN pp USING (email_id) LEFT JOIN bonus USING (email_id)
)"""


# --- links ---------------------------------------------------------------------------

HOSTS = f"""page_hosts AS (
  SELECT DISTINCT {reg("regexp_extract(url, '^https?://([^/:?#]+)', 1)")} AS domain FROM pages
), trusted AS (
  SELECT domain FROM page_hosts WHERE domain LIKE '%example.com' UNION VALUES ('paypal.com'), ('google.com')
), safe AS (SELECT domain FROM page_hosts WHERE domain LIKE '%example.org')"""


def host_of(u):
    full = f"CASE WHEN contains({u}, '://') THEN {u} ELSE 'https://' || {u} END"
    auth = rf"regexp_extract({full}, '^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)', 1)"
    return f"lower(regexp_replace(regexp_replace({auth}, '^.*@', ''), ':.*$', ''))"


def label_of(d):
    hit = rf"regexp_extract({reg(d)}, '^([^.]+)[.](?:{_ALT})$', 1)"
    return (rf"coalesce(nullif({hit}, ''), CASE WHEN regexp_matches({d}, '^\d{{1,3}}([.]\d{{1,3}}){{3}}$') "
            rf"THEN {d} ELSE regexp_extract(lower({d}), '[^.]*$', 0) END)")


_L = r"[a-zA-Z0-9](?:[a-zA-Z0-9\-]{0,61}[a-zA-Z0-9])?"
BODY_URL = rf"(?:https?://|www\.){_L}(?:\.{_L})*(?:[/?#][^\s]*)?"


def prepared(source, url="url"):
    """prep(url, hostname, registrable, error) of the distinct URLs of a source."""
    t = strip(f"coalesce({url}, '')")
    return rf"""u0 AS (SELECT DISTINCT {url} AS url, {t} AS t FROM {source}),
u1 AS (SELECT *, {host_of('t')} AS h,
         CASE WHEN contains(t, '://') THEN lower(regexp_extract(t, '^([a-zA-Z][a-zA-Z0-9+.\-]*)://', 1))
              ELSE 'https' END AS scheme FROM u0),
u2 AS (SELECT *, rtrim(h, '.') AS c FROM u1),
u3 AS (SELECT *, CASE WHEN t = '' THEN 'Missing URL or domain.'
    WHEN scheme NOT IN ('http', 'https') THEN 'Only http and https links are supported.'
    WHEN h = '' THEN 'URL does not contain a valid hostname.'
    WHEN NOT regexp_matches(c, '^(?:{_L}[.])*{_L}$') THEN 'Hostname format looks invalid.' ELSE '' END AS error FROM u2),
prep AS (SELECT url, t, error, CASE WHEN error = '' THEN c END AS hostname,
                CASE WHEN error = '' THEN {reg('c')} END AS registrable FROM u3)"""


def facts(source, url="url"):
    """facts(url, ..., trusted, structure, brand_*) against the CTEs trusted and safe."""
    return rf"""{prepared(source, url)},
f1 AS (SELECT *, coalesce(registrable IN (SELECT domain FROM trusted UNION SELECT domain FROM safe)
                 OR hostname IN (SELECT domain FROM safe), false) AS is_listed,
    CASE WHEN regexp_matches(hostname, '^\d{{1,3}}([.]\d{{1,3}}){{3}}$') THEN 'Uses an IP address instead of a normal domain.'
         WHEN starts_with(hostname, 'xn--') OR contains(hostname, '.xn--')
           THEN 'Uses punycode encoding, which is often used in lookalike domains.'
         WHEN length(hostname) - length(replace(hostname, '-', '')) >= 4 THEN 'Uses an unusually hyphenated domain name.'
         WHEN length(regexp_replace(registrable, '[^0-9]', '', 'g')) >= 4
              AND length(regexp_replace(registrable, '[^0-9]', '', 'g'))
                > length(regexp_replace(registrable, '[^\p{{L}}]', '', 'g'))
           THEN 'Uses unusually heavy digit patterns in the domain.' ELSE '' END AS structure FROM prep),
brands AS (SELECT brand, min(domain) AS site FROM (
    SELECT domain, regexp_extract(domain, '^([^.]+)[.](?:{_ALT})$', 1) AS brand FROM trusted) WHERE brand <> '' GROUP BY brand),
bt AS (SELECT registrable AS d, list_filter(regexp_split_to_array({label_of('registrable')}, '[^a-z0-9]+'), lambda k: k <> '') AS ts
    FROM (SELECT DISTINCT registrable FROM f1 WHERE error = '' AND NOT is_listed AND structure = '')),
bp AS (SELECT d, ts, tok, brand, site, levenshtein(tok, brand) AS dist
    FROM (SELECT d, ts, unnest(ts) AS tok FROM bt), brands WHERE length(tok) >= 4 AND length(brand) >= 4),
bc AS (
  SELECT d, 0 AS dist, site, 'Domain reuses a trusted brand name with risky modifiers: '
      || array_to_string(list_slice(mods, 1, 3), ', ') || '.' AS reason
  FROM (SELECT *, list_sort(list_distinct(list_filter(ts, lambda k: k <> brand AND k IN {in_list(K.RISKY_BRAND_MODIFIERS)}))) AS mods
        FROM bp WHERE tok = brand) WHERE len(mods) > 0
  UNION ALL
  SELECT d, dist, site, 'Domain looks similar to trusted site "' || site || '" (distance ' || dist || ').'
  FROM bp WHERE dist > 0 AND dist <= CASE WHEN length(brand) < 8 THEN 1 ELSE 2 END),
bb AS (SELECT d, dist, site, reason FROM bc QUALIFY row_number() OVER (PARTITION BY d ORDER BY dist, site) = 1),
facts AS (SELECT f1.*, bb.site AS brand_site, bb.dist AS brand_distance, bb.reason AS brand_reason
    FROM f1 LEFT JOIN bb ON bb.d = f1.registrable AND error = '' AND NOT is_listed AND structure = '')"""


def registrable_sender(c):
    """Registrable domain of a sender value, '' when it is no usable host."""
    t = f"coalesce({c}, '')"
    h = f"rtrim({host_of(t)}, '.')"
    return f"CASE WHEN {t} <> '' AND regexp_matches({h}, '^(?:{_L}[.])*{_L}$') THEN {reg(h)} ELSE '' END"


DECIDE = """CASE WHEN error <> '' THEN 'suspicious' WHEN is_listed THEN 'trusted' WHEN structure <> '' THEN 'suspicious'
       WHEN brand_site IS NOT NULL THEN 'suspicious' WHEN srd <> '' AND registrable = srd THEN 'aligned'
       ELSE 'normal' END AS status,
  CASE WHEN error <> '' THEN error WHEN is_listed THEN 'Domain matched the trusted list.' WHEN structure <> '' THEN structure
       WHEN brand_site IS NOT NULL THEN brand_reason WHEN srd <> '' AND registrable = srd THEN 'Domain matches the sender domain.'
       ELSE 'Domain is valid and looks structurally normal.' END AS reason,
  CASE WHEN error <> '' THEN t ELSE registrable END AS domain,
  CASE WHEN error <> '' THEN NULL WHEN is_listed THEN registrable WHEN structure <> '' THEN ''
       ELSE coalesce(brand_site, '') END AS closest_trusted,
  CAST(CASE WHEN error <> '' THEN NULL WHEN is_listed THEN 0 WHEN structure <> '' THEN NULL
       ELSE brand_distance END AS INTEGER) AS lookalike_distance"""


def base(u):
    h = rf"regexp_replace(regexp_replace({u}, '^.*?://', '', 's'), '[/?#].*$', '', 's')"
    pair = "|".join(K.SECOND_LEVEL_LABELS)
    land = "|".join(K.SECOND_LEVEL_COUNTRIES)
    return (f"CASE WHEN regexp_matches({h}, '[.]({pair})[.]({land})$') AND len(string_split({h}, '.')) > 2 "
            f"THEN regexp_extract({h}, '[^.]*[.][^.]*[.][^.]*$', 0) "
            f"WHEN len(string_split({h}, '.')) > 2 THEN regexp_extract({h}, '[^.]*[.][^.]*$', 0) ELSE {h} END")


def body_hosts(c):
    return (rf"list_transform(regexp_extract_all({c}, '{BODY_URL}'), "
            rf"lambda k: {reg(r"regexp_extract(regexp_replace(k, '^https?://', ''), '^[^/?#]*', 0)")})")


TEXT_HOST = r"lower(nullif(regexp_extract({c}, '[\p{{L}}\p{{N}}_.-]+@([\p{{L}}\p{{N}}_.-]+\.[\p{{L}}\p{{N}}_]+)', 1), ''))"

REQUESTS = f"""requests AS (
  SELECT email_id, {clean('"from"')} AS sender, {clean('subject')} AS subject, {clean('body')} AS body,
         {clean("split_part(coalesce(urls, ''), ',', 1)")} AS url, label, (email_id * 37 % 1000) / 1000 AS p
  FROM emails
)"""

LINKS = f"""cand AS (
  SELECT email_id, sender, unnest(x) AS d, generate_subscripts(x, 1) AS pos
  FROM (SELECT email_id, sender, list_append({body_hosts('body')}, url) AS x FROM requests)
), links AS (
  SELECT email_id, {TEXT_HOST.format(c='sender')} AS sender_domain, {base('d')} AS url, min(pos) AS pos
  FROM cand WHERE d <> '' GROUP BY ALL
)"""

CHECKED = f"""near AS (
  SELECT url, dist, site FROM (
    SELECT u.url, s.domain AS site, levenshtein(u.url, s.domain) AS dist
    FROM (SELECT DISTINCT url FROM links) u, trusted s)
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY dist, site) = 1
), judged AS (
  SELECT l.email_id, l.pos, l.url, {DECIDE}, n.dist AS near_dist, n.site AS near_site
  FROM (SELECT *, {registrable_sender('sender_domain')} AS srd FROM links) l
  JOIN facts f ON f.url = l.url JOIN near n ON n.url = l.url
), edits AS (
  SELECT *, CAST(CASE WHEN coalesce(closest_trusted, '') <> '' THEN coalesce(lookalike_distance, 0) ELSE near_dist END AS INTEGER) AS ed,
    CASE WHEN coalesce(closest_trusted, '') <> '' THEN closest_trusted ELSE near_site END AS ec FROM judged
), alike AS (
  SELECT *, (status = 'suspicious' AND coalesce(closest_trusted, '') <> '' AND ed <= 2) OR (ed <= 2 AND ed <> 0) AS look FROM edits
), per_mail AS (
  SELECT email_id, string_agg(url, '|' ORDER BY pos) AS urls,
    string_agg(status, '|' ORDER BY pos) AS url_status,
    string_agg(CASE WHEN status = 'trusted' THEN 'true' ELSE 'false' END, '|' ORDER BY pos) AS url_check,
    string_agg(ed || ':' || ec, '|' ORDER BY pos) AS edit_check,
    string_agg(url, '|' ORDER BY pos) FILTER (status = 'suspicious') AS suspicious_urls,
    string_agg(url, '|' ORDER BY pos) FILTER (status IN ('aligned', 'normal')) AS neutral_urls,
    string_agg(url || ':' || ed || ':' || ec, '|' ORDER BY pos) FILTER (look) AS lookalikes,
    first(struct_pack(u := url, d := ed, c := ec) ORDER BY pos) FILTER (look) AS first_look
  FROM alike GROUP BY email_id
)"""

# one row per mail with every signal and the fused verdict
VERDICT = f"""signals AS (
  SELECT r.email_id, CASE WHEN content THEN r.p ELSE 0 END AS prob, content,
    CASE WHEN content AND r.p >= 0.42 THEN 'Spam' ELSE 'Safe' END AS model_prediction,
    x.keyword_score, x.keywords, f.sender_host, f.sender_category,
    coalesce(m.urls, '') AS urls, coalesce(m.url_status, '') AS url_status, coalesce(m.url_check, '') AS url_check,
    coalesce(m.edit_check, '') AS edit_check, coalesce(m.suspicious_urls, '') AS suspicious_urls,
    coalesce(m.neutral_urls, '') AS neutral_urls, coalesce(m.lookalikes, '') AS lookalikes, m.first_look
  FROM (SELECT *, sender || subject || body || url <> '' AS content FROM requests) r
  JOIN lex x USING (email_id) JOIN found f USING (email_id) LEFT JOIN per_mail m USING (email_id)
), flagged AS (
  SELECT *, round_even(prob, 4) AS model_probability, round_even(prob * 100, 1) AS model_score,
    CASE WHEN content THEN round_even(greatest(prob, 1 - prob), 4) ELSE 0 END AS model_confidence,
    model_prediction = 'Spam' AS f_model, keyword_score >= 50 AS f_keyword, suspicious_urls <> '' AS f_url,
    lookalikes <> '' AS f_look, lower(sender_category) IN ('spam', 'suspicious') AS f_sender
  FROM signals
), voted AS (
  SELECT *, f_model::INT + f_keyword::INT + f_url::INT + f_look::INT + f_sender::INT AS spam_votes FROM flagged
), labelled AS (
  SELECT *, CASE WHEN model_probability >= 0.5 OR f_url OR f_look OR (model_probability >= 0.4 AND spam_votes >= 2)
                 THEN 'Spam' ELSE 'Safe' END AS final_label,
    round_even((CAST(round(model_probability * 10000) AS BIGINT) * 78 + spam_votes * 44000) / 1000, 0) / 10 AS base_score
  FROM voted
), verdict AS (
  SELECT *, CASE WHEN level_score >= 80 THEN 'High' WHEN level_score >= 55 THEN 'Medium' ELSE 'Low' END AS risk_level,
    level_score AS overall_score,
    CASE WHEN final_label = 'Spam' AND level_score >= 80
           THEN 'This email looks strongly suspicious and matches patterns seen in phishing emails.'
         WHEN final_label = 'Spam' THEN 'This email shows enough phishing signals that it should be treated with caution.'
         WHEN model_probability < 0.2 THEN 'This email looks safe based on the trained model and the supporting checks.'
         ELSE 'This email leans safe overall, but you should still review any unexpected links carefully.' END AS verdict_message
  FROM (SELECT *, CASE WHEN final_label = 'Spam' THEN greatest(base_score, 60.0) ELSE base_score END AS level_score FROM labelled)
)"""


def verdict(final):
    return ctes(EMAILS, REQUESTS, HOSTS, reputation(), sender("requests", mailbox_host("sender")), lexicon("requests"),
                LINKS, facts("links"), CHECKED, VERDICT, final=final)


def top(list_text, n):
    """First n parts of a '|' list, joined by ', '."""
    return f"array_to_string(list_slice(string_split({list_text}, '|'), 1, {n}), ', ')"
