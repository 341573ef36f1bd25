"""Literal cases with known expected values."""

import random

import pytest
from pyspark.sql import functions as F

from mailtriage import schemas as SC
from mailtriage.functions import features as FE, headers as H, text as X, urls as U
from mailtriage.operators import (domains as D, explain as EX, lexicon as LX, links as LK, lookalike as LA,
                                  ordering as O, scoring as S, sender as SE)
from mailtriage.sources import files as FS


def one(df):
    return df.first()[0]


# --- sender reputation -----------------------------------------------------------------

@pytest.fixture
def reputation(frame):
    return frame("domain string, legitimacy_score int, total_occurrences long, in_spam long, in_ham long, "
                 "sources string, category string",
                 ("example.com", 95, 10, 2, 8, "from", "legitimate"),
                 ("lowocc.com", 85, 3, 1, 2, "urls", "uncertain"))


@pytest.mark.parametrize("small", [True, False])
def test_sender_lookup(frame, reputation, small):
    mails = frame("email_id int, from string", (1, "user@example.com"), (2, "someone@lowocc.com"),
                  (3, "user@unknown.com"), (4, "not-an-email"), (5, None), (6, "X <u@Example.COM>"))
    got = {r["email_id"]: (r["sender_host"], r["sender_category"], r["sender_occurrences"], r["lookup_status"])
           for r in SE.sender_reputation(mails, reputation, small=small).collect()}
    assert got == {
        1: ("example.com", "legitimate", 10, "matched"), 2: ("lowocc.com", "suspicious", 3, "matched"),
        3: ("unknown.com", "unknown", 0, "unknown"), 4: ("Not Found", "Not Found", None, "not_found"),
        5: ("Not Found", "Not Found", None, "not_found"), 6: ("example.com", "legitimate", 10, "matched")}


def test_sender_lookup_without_table(frame, reputation):
    mails = frame("email_id int, from string", (1, "user@example.com"))
    for table in (None, reputation.drop("sources")):
        row = SE.sender_reputation(mails, table).first()
        assert (row["sender_host"], row["sender_category"]) == ("example.com", "unknown")


# --- nearest site -------------------------------------------------------------------------

def test_nearest_site(frame):
    sites = frame("domain string", ("paypal.com",), ("google.com",), ("example.com",))
    asked = frame("domain string", ("paypal.com",), ("paypa.com",), ("paypol.com",), ("zz.zz",))
    got = {r["domain"]: (r["distance"], r["closest"]) for r in LA.nearest_sites(asked, sites).collect()}
    assert got["paypal.com"] == (0, "paypal.com")
    assert got["paypa.com"] == (1, "paypal.com")
    assert got["paypol.com"] == (1, "paypal.com")


def test_nearest_site_of_empty_list(frame):
    got = LA.nearest_sites(frame("domain string", ("randomsite.com",)), frame("domain string"))
    assert [tuple(r) for r in got.collect()] == [("randomsite.com", 99, "")]


# --- lexicon --------------------------------------------------------------------------------

def score(frame, subject, body):
    return LX.lexicon_score(frame("id int, subject string, body string", (1, subject, body))).first()


def test_phishing_text(frame):
    row = score(frame, "Urgent action: verify your account", "Verify your account or lose access today")
    assert 50 <= row["keyword_score"] <= 100
    assert {"urgent", "verify"} <= set(row["matched"])


def test_safe_text(frame):
    assert score(frame, "Garden tools", "The rake and the spade are in the shed.")["keyword_score"] < 20


def test_exact_score(frame):
    # reset: 8 + 2.8 (subject); password: 10 + 3.5; phrase "password reset": 24; breadth 2 * 1.75
    assert score(frame, "Mailbox password reset", "Reset it")["keyword_score"] == 8 + 2.8 + 10 + 3.5 + 24 + 3.5


def test_matched_words(frame):
    assert {"password", "reset"} <= set(score(frame, "Mailbox password reset", "Reset it")["matched"])


def test_adult_text(frame):
    row = score(frame, "Members are waiting", "Adult chat rooms\nPrivate chat\nExclusive photos of singles\nDating for free")
    assert row["keyword_score"] >= 50 and row["keyword_label"] == "Spam"
    assert {"adult", "chat", "private", "exclusive", "photos"} <= set(row["matched"])


def test_empty_text(frame):
    row = score(frame, None, "")
    assert row["keyword_score"] == 0 and row["matched"] == []


def test_hyphenated_word_counts_but_comes_last(frame):
    row = score(frame, "", "risk-free bonus")
    assert row["matched"] == ["bonus", "free"]


def test_highlight(frame):
    rows = frame("subject string, body string", ("Reset", "reset your password"))
    marked = LX.highlighted(LX.lexicon_score(rows)).first()["body_highlighted"]
    assert "padding: 2px 4px; border-radius: 3px;\">password</span>" in marked
    assert "\">reset</span>" in marked


def test_overlapping_phrases_are_counted_apart(frame):
    rows = LX.phrase_hits(frame("email_id int, subject string, body string", (1, "password reset your password reset", "")))
    assert {r["phrase"]: r["hits"] for r in rows.collect()} == {"password reset": 2, "reset your password": 1}


@pytest.mark.parametrize("text, absent", [
    ("Please verify the customer account by email.", {"account", "verify", "customer"}),
    ("Thanks for your message, our team will review the schedule.", {"message", "review", "schedule"}),
])
def test_candidate_keywords(frame, text, absent):
    words = one(frame("t string", (text,)).select(X.candidate_keywords(F.col("t"))))
    assert not absent & set(words)


# --- links --------------------------------------------------------------------------------------

@pytest.mark.parametrize("text, expected", [
    ("Pay at https://paypal.com/pay, search at http://google.com later", ["paypal.com", "google.com"]),
    ("See www.wikipedia.org and www.python.org (both)", ["wikipedia.org", "python.org"]),
    ("https://a.paypal.com/x https://b.paypal.com", ["paypal.com"]),
    ("No link in here.", None), (None, None),
])
def test_body_domains(frame, text, expected):
    assert one(frame("t string", (text,)).select(U.body_domains(F.col("t")))) == expected


ASSESSED = [
    ("paypal.com", None, "trusted", "paypal.com", 0), ("https://google.com", None, "trusted", "google.com", 0),
    ("safe.example.com", None, "trusted", "example.com", 0), ("trusted.site.com", None, "trusted", "site.com", 0),
    ("rooms-office.com", None, "normal", "", None),
    ("https://rooms-office.com/notes/monday", "desk@rooms-office.com", "aligned", "", None),
    ("https://paypal-secure-update.net", None, "suspicious", "paypal.com", 0),
    ("https://goog1e-account-help.com", None, "suspicious", "google.com", 1),
    ("http://10.11.12.13/panel", None, "suspicious", "", None),
    ("http://xn--ggle-0nda.com", None, "suspicious", "", None), ("win-big-now-and-today.net", None, "suspicious", "", None),
    ("987654.co.uk", None, "suspicious", "", None),
    ("gardenshed.com", None, "normal", "", None), ("http://pottery.site", None, "normal", "", None),
    ("ftp://paypal.com", None, "suspicious", None, None),
    ("mailto:desk@example.com", None, "normal", "", None),
    ("", None, "suspicious", None, None), (None, None, "suspicious", None, None),
    ("https://exa mple.com", None, "suspicious", None, None),
]


@pytest.mark.parametrize("small", [True, False])
def test_link_assessment(frame, small):
    trusted = frame("domain string", ("paypal.com",), ("google.com",))
    safe = frame("domain string", ("safe.example.com",), ("trusted.site.com",))
    links = frame("i int, url string, sender_domain string", *[(i, a[0], a[1]) for i, a in enumerate(ASSESSED)])
    got = {r["i"]: r for r in LK.assess(links, trusted, safe, F.col("i"), small=small).collect()}
    for i, (url, sender, status, closest, distance) in enumerate(ASSESSED):
        r = got[i]
        assert (r["status"], r["closest_trusted"], r["lookalike_distance"]) == (status, closest, distance), url
        assert r["is_suspicious"] == (status == "suspicious") and r["is_trusted"] == (status == "trusted")
    assert "secure, update" in got[6]["reason"]


def test_membership(frame):
    names = frame("domain string", ("paypal.com",), ("safe.example.com",))
    rows = frame("d string", ("PayPal.com",), ("unknown.com",), ("",), (None,), ("safe.example.com",))
    got = {r["d"]: r["hit"] for r in D.membership(rows, names, "d", F.lit(1), "hit").collect()}
    assert got == {"PayPal.com": True, "unknown.com": False, "": False, None: False, "safe.example.com": True}


@pytest.mark.parametrize("url, expected", [
    ("https://mail.example.com/path", "example.com"), ("a.b.co.uk?q", "b.co.uk"), ("x.y.co.za", "co.za"),
    ("http://10.11.12.13/panel", "12.13"), ("localhost", "localhost"),
])
def test_base_domain(frame, url, expected):
    assert one(frame("u string", (url,)).select(U.base_domain(F.col("u")))) == expected


@pytest.mark.parametrize("host, expected", [
    ("www.linux.ie", "linux.ie"), ("A.B.CO.UK", "b.co.uk"), ("co.uk", "co.uk"), ("192.168.1.10", "192.168.1.10"),
    ("user@x.paypal.com:8080", "paypal.com"), ("nosuffix:80", "nosuffix:80"), ("a.b.unknown", "a.b.unknown"),
])
def test_registrable(frame, host, expected):
    assert one(frame("h string", (host,)).select(U.registrable(F.col("h")))) == expected


@pytest.mark.parametrize("small", [True, False])
def test_suffix_rules_with_wildcard_and_exception(frame, small):
    rules = ["com", "jp", "*.kawasaki.jp", "!city.kawasaki.jp"]
    hosts = frame("host string", ("x.com",), ("a.b.c.kawasaki.jp",), ("a.city.kawasaki.jp",), ("kawasaki.jp",), ("z.a.jp",))
    table = D.registrable_by_table(hosts, frame("suffix string", *[(r,) for r in rules]), small=small)
    inline = hosts.select("host", U.registrable(F.col("host"), rules).alias("registrable"))
    expected = {"x.com": "x.com", "a.b.c.kawasaki.jp": "b.c.kawasaki.jp", "a.city.kawasaki.jp": "city.kawasaki.jp",
                "kawasaki.jp": "kawasaki.jp", "z.a.jp": "a.jp"}
    assert dict(map(tuple, table.collect())) == expected
    assert dict(map(tuple, inline.collect())) == expected


# --- text and headers -----------------------------------------------------------------------

@pytest.mark.parametrize("value, expected", [
    (" a\t\n", "a"), ("NaN", ""), ("none ", ""), ("<NA>", ""), ("n/a", ""), (None, ""), ("nano", "nano")])
def test_clean_value(frame, value, expected):
    assert one(frame("t string", (value,)).select(X.clean_value(F.col("t")))) == expected


def test_html_to_text(frame):
    html = "<p>a &amp;amp; b</p>  <script>x<1</script><!-- c --><b>caf&#233; &#x20AC;</b>\n<br>3 < 4"
    assert one(frame("t string", (html,)).select(X.html_to_text(F.col("t")))) == "a & b\n\ncafé €\n\n\n3 < 4"


def test_split_message(frame):
    raw = "Subject: a\r\n b\r\nX: 1\r\n\r\nbody\r\n\r\nmore"
    s = frame("t string", (raw,)).select(H.split_message(F.col("t")).alias("s")).first()["s"]
    assert (s["header"], s["body"]) == ("Subject: a\n b\nX: 1", "body\n\nmore")
    # a line that is no header ends the block and belongs to the body
    s = frame("t string", ("Subject: a\nplain text\n\nmore",)).select(H.split_message(F.col("t")).alias("s")).first()["s"]
    assert (s["header"], s["body"]) == ("Subject: a", "plain text\n\nmore")
    s = frame("t string", ("\nbody",)).select(H.split_message(F.col("t")).alias("s")).first()["s"]
    assert (s["header"], s["body"]) == ("", "body")


def test_header_map_last_value_wins(frame):
    block = "Subject: one\n two\nFrom : a@b.c\nnoise\n three\nSUBJECT: last"
    assert one(frame("t string", (block,)).select(H.header_map(F.col("t")))) == {"subject": "last", "from": "a@b.c three"}


@pytest.mark.parametrize("value, expected", [
    ("A <a@b.com>, C < c@d.org >", "a@b.com, c@d.org"), ("a@b.com; x", "a@b.com"), ("[No] 'mail'", "No mail"), (None, None)])
def test_addresses(frame, value, expected):
    assert one(frame("t string", (value,)).select(H.normalise_addresses(F.col("t")))) == expected


def test_clean_keywords(frame):
    words = ["Zeta", "ab", "x" * 31, "http-x", "a1b", "risk-free", "zeta "]
    assert one(frame("w array<string>", (words,)).select(X.clean_keywords(F.col("w")))) == ["risk-free", "zeta"]


# --- features and explanation ------------------------------------------------------------------

def test_numeric_features(frame):
    mails = frame("subject string, body string, from string, urls string",
                  ("URGENT now", "Log in NOW! $5 usd http://1.2.3.4/a free", "A <a@x.gmail.com>", "http://1.2.3.4/a, a-b-c.com"))
    r = FE.training_features(mails).first()
    assert (r["subject_length"], r["url_count"], r["sender_domain_depth"], r["uppercase_token_count"]) == (10, 2, 2, 2)
    assert (r["urgency_term_count"], r["account_term_count"], r["offer_term_count"]) == (3, 1, 1)
    assert (r["currency_symbol_count"], r["ip_url_count"], r["hyphenated_url_count"], r["link_token_count"]) == (2, 1, 1, 1)
    assert r["sender_is_free_mail"] == 0 and r["exclamation_count"] == 1


def test_readable_reason(frame):
    rows = frame("s string, v string", ("subject_word", "verify_account"), ("body_word", "body"), ("combined_char", "abc"),
                 ("body_word", "12 3"), ("numeric", "url_count"), ("other", "x"))
    plain = [r[0] for r in rows.select(EX.readable_reason(F.col("s"), F.col("v"))).collect()]
    named = [r[0] for r in rows.select(EX.readable_reason(F.col("s"), F.col("v"), True)).collect()]
    assert plain == ['Subject mentions "verify account"', None, None, None, None, None]
    assert named[4] == "Email contains several links"


def test_required_columns(frame):
    with pytest.raises(ValueError, match="body, label, urls"):
        SC.require_columns(frame("subject string, `from` string"), ["subject", "body", "from", "urls", "label"])


# --- whole verdicts ---------------------------------------------------------------------------

def verdicts(frame, *mails):
    rows = frame("email_id int, sender_email string, subject string, body string, url string, p double", *mails)
    trusted = frame("domain string", ("paypal.com",), ("google.com",))
    reputation = frame("domain string, legitimacy_score int, total_occurrences long, in_spam long, in_ham long, "
                       "sources string, category string", ("goog1e-mailer.com", 5, 9, 9, 0, "from", "spam"))
    got = S.score_mails(rows, trusted, frame("domain string"), reputation)
    return {r["email_id"]: r for r in got.collect()}


def test_verdicts(frame):
    got = verdicts(
        frame, (1, None, None, None, None, 0.9), (2, None, None, "nan", None, 0.9),
        (3, "info@goog1e-mailer.com", "Confirm your account: urgent action",
         "Your wallet is suspended, confirm at https://goog1e-account-help.com", "https://goog1e-account-help.com", 0.6),
        (4, "desk@rooms-office.com", "Key for the blue room",
         "The notes are at https://rooms-office.com/notes/monday.",
         "https://rooms-office.com/notes/monday", 0.1),
        (5, "x@quvorimel.ru", "Members are waiting", "Adult chat rooms\n\nPrivate chat\nExclusive photos\n"
         "Dating for free", "", 0.55))
    for i in (1, 2):
        r = got[i]
        assert (r["final_label"], r["overall_score"], r["model_probability"], r["spam_votes"]) == ("Safe", 0.0, 0.0, 0)
        assert r["reasons"] == ["No strong phishing wording, link issues, or sender-domain risks were found."]
    r = got[3]
    assert r["url_status"] == ["suspicious"] and r["spam_votes"] >= 3 and r["final_label"] == "Spam"
    assert r["check_flags"]["url_safety"] and r["check_flags"]["lookalike_domains"] and r["check_flags"]["sender_domain"]
    assert r["edit_check"] == [(1, "google.com")]
    r = got[4]
    assert (r["final_label"], r["url_status"], r["spam_votes"]) == ("Safe", ["aligned"], 0)
    r = got[5]
    assert r["final_label"] == r["keyword_label"] == r["model_prediction"] == "Spam"
    assert not r["check_flags"]["url_safety"] and not r["check_flags"]["lookalike_domains"]
    assert [c["name"] for c in r["checks_breakdown"]] == [
        "Trained Model", "Keyword Scan", "URL Safety", "Lookalike Domains", "Sender Domain"]


# --- scoring without usable ids ---------------------------------------------------------------

MAILS = "id string, sender_email string, subject string, body string, url string, p double"


def test_ids_do_not_matter(frame):
    """Null and repeated ids: every mail keeps its own links."""
    fake, plain = "log in at http://paypa1.com", "the shed is open"
    rows = frame(MAILS, ("k", None, "a", fake, None, 0.1), (None, None, "b", fake, None, 0.1), ("k", None, "c", plain, None, 0.1),
                 (None, None, "d", plain, None, 0.1))
    got = S.score_mails(rows, frame("domain string", ("paypal.com",)), frame("domain string"), None, key="id").collect()
    assert sorted((r["id"] or "", r["final_label"], tuple(r["urls"])) for r in got) == [
        ("", "Safe", ()), ("", "Spam", ("paypa1.com",)), ("k", "Safe", ()), ("k", "Spam", ("paypa1.com",))]
    assert len(S.score_mails(rows.drop("id"), frame("domain string", ("paypal.com",)), frame("domain string"), None, key="id").collect()) == 4


def test_very_long_url(frame):
    rows = frame(MAILS, ("a", None, "x", "y", "http://" + "z" * 100_000, 0.1))
    r = S.score_mails(rows, frame("domain string", ("paypal.com",)), frame("domain string"), None, key="id").first()
    assert r["edit_check"][0]["distance"] == 99 and r["lookalikes"] == []


def test_threshold_of_the_model(frame):
    rows = frame(MAILS, ("a", None, "x", "y", None, 0.45))
    for threshold, label in ((0.42, "Spam"), (0.5, "Safe")):
        r = S.score_mails(rows, frame("domain string"), frame("domain string"), None, key="id", threshold=threshold).first()
        assert r["model_prediction"] == label and ("leaned toward" in " ".join(r["reasons"])) == (label == "Spam")


def test_nearest_site_ties_follow_the_list(frame):
    sites = frame("rank int, domain string", (1, "zb.com"), (2, "ab.com"))
    rows = frame(MAILS, ("a", None, "x", "see http://cb.com", None, 0.1))
    r = S.score_mails(rows, sites, frame("domain string"), None, key="id").first()
    assert r["edit_check"] == [(1, "zb.com")]


def test_candidate_pairs_stay_few(frame, monkeypatch):
    """The variant join measures pairs that share a variant, not all pairs."""
    left = [(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{i:03d}host.org",) for i in range(200)]
    seen = LA.edit_neighbours(frame("left string", *left), frame("right string", *left))
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "_v" in plan
    variants = lambda c: frame(f"{c} string", *left).select(c, F.explode(LA.deletion_keys(F.col(c), F.lit(2))).alias("v"))
    pairs = variants("left").join(variants("right"), "v").select("left", "right").distinct().count()
    assert pairs < 0.5 * len(left) ** 2


def test_null_labels_are_an_error(frame):
    rows = frame("email_id int, label int", (1, 0), (2, 1), (3, None))
    with pytest.raises(Exception, match="without a value in label"):
        O.stratified_split(rows, "email_id", "label").collect()


# --- suffix rules and MIME parts ---------------------------------------------------------------

def test_long_rule_lists_agree_with_the_table(spark):
    rng = random.Random(1)
    names = sorted({"".join(rng.choice("abcdexyz") for _ in range(rng.randrange(2, 5))) for _ in range(900)})
    rules = names + [f"{a}.{b}" for a, b in zip(names[:600], names[300:])] + [f"*.{n}" for n in names[:40]]
    rules += [f"!city{i}.{n}" for i, n in enumerate(names[:40])]
    hosts = [".".join(rng.choice(["www", "city3", "a", *names]) for _ in range(rng.randrange(1, 6))) for _ in range(3000)] + ["city3." + n for n in names[:9]]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    table = D.registrable_by_table(df, spark.createDataFrame([(r,) for r in rules], "suffix string"))
    want = dict(map(tuple, table.collect()))
    got = dict(map(tuple, df.select("host", U.registrable(F.col("host"), rules)).collect()))
    assert got == want


def test_suffix_file(spark, tmp_path):
    (tmp_path / "rules.dat").write_text("// comment\n\ncom\nCO.uk\n*.ck\n!www.ck\n")
    rules = FS.suffix_rules(spark, str(tmp_path / "rules.dat"))
    assert rules == ["!www.ck", "*.ck", "co.uk", "com"]
    host = lambda h: one(spark.createDataFrame([(h,)], "h string").select(U.registrable(F.col("h"), rules)))
    assert [host(h) for h in ("a.b.co.uk", "x.y.z.ck", "a.www.ck", "a.b.pl")] == ["b.co.uk", "y.z.ck", "www.ck", "a.b.pl"]


def test_nested_multipart(frame):
    mail = ("Subject: s\nContent-Type: multipart/mixed; boundary=\"o\"\n\npre\n--o\nContent-Type: multipart/alternative;\n boundary=i\n\n--i\n"
            "Content-Type: text/plain\n\nplain words\n--i\nContent-Type: text/html\nContent-Transfer-Encoding: quoted-printable\n\n<b>1=3D1 =E2=82=AC</b>\n--i--\n--o\n"
            "Content-Type: image/png\n\nxx\n--o\nContent-Type: text/plain\nContent-Transfer-Encoding: base64\n\nYmFz\nZTY0\n--o--\nepilogue\n")
    assert H.parse_headers(frame("message string", (mail,))).first()["body"] == "plain words\n\n<b>1=1 €</b>\n\nbase64"
    plain = "Subject: s\n\nboundary=x --x text"
    assert H.parse_headers(frame("message string", (plain,))).first()["body"] == "boundary=x --x text"
