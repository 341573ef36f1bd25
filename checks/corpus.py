"""Mail tables derived from the given document, page and label tables.

``emails`` turns every document into one mail.  Two small decks, picked by document
number, add subjects, sentences and links, so that every rule has rows to act on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailtriage.functions.literals import mapping

# rules under which the page hosts do not collapse into three domains
CORPUS_SUFFIXES = ["com", "net", "org", "uk", "co.uk", "ru",
                   "example.com", "example.net", "example.org"]

PHRASE_DECK = {  # slot -> (subject addition, body addition)
    0: ("URGENT notice: confirm your account", "Kindly verify your account and confirm your account today."),
    2: ("Mailbox password reset", "To reset your password, click here before the limited time is over."),
    3: ("Garden tools", "The rake and the spade are in the shed."),
    4: ("Waiting tonight", "ADULT CHAT for members: private chat, exclusive photos, dating. "
                           "Accept to enter."),
    5: ("nan", ""),
    6: ("LUCKY WINNER of the draw", "A prize of $900 USD and a free gift!!! Claim it at "
                                    "www.google.com/lucky"),
}
LINK_DECK = [
    "http://10.11.12.13/panel", "https://paypal-secure-update.net/signin",
    "https://goog1e-account-help.com/start", "http://xn--ggle-0nda.com/",
    "https://win-big-now-and-today.net/x", "ftp://files.example.com/x", "https://paypal.com/",
    "www.google.com/search?q=1", "http://987654.co.uk", None,
    "https://rooms-office.com/notes",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(slot: Column, values: dict) -> Column:
    return F.try_element_at(mapping({k: v for k, v in values.items() if v is not None}), slot.cast("int"))


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """email_id, subject, body, from, to, urls, label, lang: one row per document."""
    docs = table(spark, sf_dir, "documents")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    n_pages = pages.agg(F.count("*").alias("n")).scalar()
    doc, slot, link = F.col("doc_id"), F.col("doc_id") % 10, F.col("doc_id") % 11

    page_url = F.when(doc % 2 == 0, F.col("url"))
    deck_url = _pick(link, dict(enumerate(LINK_DECK)))
    address = F.when(F.contains("text", F.lit("@")), F.regexp_extract("text", r"[a-z]+[.][0-9]+@[a-z0-9]+[.]example[.]com", 0)).otherwise("")
    page_host = F.regexp_extract("url", r"^https?://([^/:?#]+)", 1)
    sender = (
        F.when(address != "", F.concat(F.lit("Doc <"), address, F.lit(">")))
        .when(doc % 4 == 0, F.concat(F.lit("User "), doc, F.lit(" <u"), doc, F.lit("@"), page_host, F.lit(">")))
        .when(doc % 4 == 1, F.concat(F.lit("u"), doc, F.lit("@rooms-office.com")))
        .when(doc % 4 == 2, "not-an-email").otherwise("alerts@gmail.com")
    )
    subject = F.when(slot == 5, "nan").otherwise(F.concat_ws(
        " ", _pick(slot, {k: v[0] for k, v in PHRASE_DECK.items()}),
        F.substring_index("text", "\n", 1)))
    body_add = _pick(slot, {k: v[1] or None for k, v in PHRASE_DECK.items()})
    fallback = F.when(slot.isin(0, 2, 4, 6), 1).otherwise(0)
    return (
        docs.withColumn("page_id", doc % n_pages)
        .join(pages, "page_id", "left").join(labels, "doc_id", "left")
        .select(
            doc.alias("email_id"), subject.alias("subject"),
            F.concat_ws(" ", "text", body_add, page_url, deck_url).alias("body"),
            sender.alias("from"), F.concat("source", F.lit("@inbox.example.org")).alias("to"),
            F.nullif(F.concat_ws(", ", page_url, deck_url), F.lit("")).alias("urls"),
            F.coalesce(F.col("toxic"), fallback).cast("int").alias("label"), "lang",
        )
    )


def raw_messages(mails: DataFrame) -> DataFrame:
    """email_id, label, message: every mail written out as a raw message.

    Mails divisible by 7 occur twice, by 9 carry a leaked header line, by 13 have a blank
    subject and a second header block on top of the body; others vary in optional fields.
    Every 23rd is multipart with a base64 and a quoted-printable part and an attachment.
    """
    n = F.col("email_id")
    subject = F.when(n % 13 == 0, "").otherwise(
        F.when(n % 4 == 1, F.concat("subject", F.lit("\n folded tail"))).otherwise(F.col("subject")))
    head = F.concat_ws(
        "\n",
        F.concat(F.lit("Message-ID: <m"), n, F.lit("@mail.example.org>")),
        F.lit("Date: Tue, 08 Apr 2025 09:15:00 +0800"),
        F.concat(F.lit("From: "), "from"), F.concat(F.lit("To: "), "to"),
        F.concat(F.lit("Subject: "), subject),
        F.when(n % 3 == 0, F.concat(F.lit("Sender: "), "to")),
        F.when(n % 5 == 0, F.concat(F.lit("List-Id: news "), n % 3, F.lit(" <list.example.org>"))),
        F.lit("X-Loop: a"),
    )
    second = F.when(n % 13 == 0, F.concat(
        F.lit("Subject: recovered "), n, F.lit("\n\tsecond line\nX-Mailer: one\nSubject: again "), n, F.lit("\n\n")))
    leaked = F.when(n % 9 == 0, F.concat(F.lit("\nX-Tag: t"), n, F.lit("\nend")))
    content = F.concat(F.coalesce(second, F.lit("")), "body", F.coalesce(leaked, F.lit("")))
    mark = F.concat(F.lit("\n--sep-"), n)
    parts = F.concat(
        F.lit("\nContent-Type: multipart/mixed; boundary=\"sep-"), n, F.lit("\"\n\nno text"), mark,
        F.lit("\nContent-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: base64\n\n"), F.regexp_replace(F.base64(content.cast("binary")), r"\s", ""), mark,
        F.lit("\nContent-Type: text/html\nContent-Transfer-Encoding: quoted-printable\n\ncaf=C3=A9 soft=\nline 100% =3D "), n, mark,
        F.lit("\nContent-Type: application/pdf\nContent-Disposition: attachment\n\nQUJD"), mark, F.lit("--\n"))
    message = F.concat(head, F.when(n % 23 == 5, parts).otherwise(F.concat(F.lit("\n\n"), content)))
    copies = F.when(n % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return mails.select(n, "label", message.alias("message"), F.explode(copies).alias("copy")).select(
        (n * 2 + F.col("copy")).alias("email_id"), "label", "message")


def with_probability(mails: DataFrame) -> DataFrame:
    """Mails with a stand-in probability ``p`` in place of a model's."""
    return mails.withColumn("p", (F.col("email_id") * 37 % 1000) / 1000)


def trusted_deck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted sites of the checks: two brands and every page host under example.com."""
    from mailtriage.functions.urls import hostname, registrable

    pages = table(spark, sf_dir, "pages")
    host = registrable(hostname(F.col("url")), CORPUS_SUFFIXES)
    brands = pages.select(F.explode(F.array(F.lit("paypal.com"), F.lit("google.com"))).alias("domain"))
    listed = pages.select(host.alias("domain")).where(F.col("domain").endswith("example.com"))
    return listed.unionByName(brands).distinct()


def safe_deck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Safe hosts of the checks: every page host under example.org."""
    from mailtriage.functions.urls import hostname, registrable

    host = registrable(hostname(F.col("url")), CORPUS_SUFFIXES)
    return (table(spark, sf_dir, "pages").select(host.alias("domain"))
            .where(F.col("domain").endswith("example.org")).distinct())
