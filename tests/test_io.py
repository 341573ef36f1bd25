"""Files, streams, the model's life cycle and the written tables."""

import json

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from mailtriage import constants as K
from mailtriage.functions import urls as U
from mailtriage.operators import ordering as O
from mailtriage.plans import corpus as PC, reputation as RP, score as PS, train as TR
from checks import corpus as C
from mailtriage.sources import files as FS, sinks as SK
from mailtriage.streaming import scoring as ST

SF = "/root/testdata/sf0.001"

PHISHING = b"""From: Help Desk <desk@goog1e-mailer.com>
To: reader@example.org
Subject: Wallet suspended, confirm today
MIME-Version: 1.0
Content-Type: text/plain; charset="utf-8"

Confirm it at
https://goog1e-account-help.com/start
"""
HTML = b"""From: a@b.com
Subject: =?utf-8?q?caf=C3=A9?=
Content-Type: text/html; charset="utf-8"

<style>p{}</style><p>Hello <b>you</b></p>
"""
MULTIPART = b"""From: c@d.com
Subject: parts
MIME-Version: 1.0
Content-Type: multipart/mixed; boundary="xx"

--xx
Content-Type: text/html

<p>rich</p>
--xx
Content-Type: text/plain

plain text
--xx
Content-Type: text/plain
Content-Disposition: attachment; filename="a.txt"

secret attachment
--xx--
"""
# an unknown charset makes the parser fail
BROKEN = b"""From: Bad <bad@mail.org>
Subject: broken
Content-Type: text/plain; charset="no-such-charset"

soft=3Dbreak \xff
"""


def test_eml_files(spark, tmp_path):
    for name, data in {"a": PHISHING, "b": HTML, "c": MULTIPART, "d": BROKEN}.items():
        (tmp_path / f"{name}.eml").write_bytes(data)
    (tmp_path / "other.txt").write_text("no mail")
    got = {r["path"][-5]: r for r in FS.eml_files(spark, str(tmp_path)).collect()}
    assert set(got) == set("abcd")
    assert got["a"]["sender_email"] == "desk@goog1e-mailer.com" and "start" in got["a"]["body"]
    assert got["b"]["subject"] == "café" and got["b"]["body"] == "Hello you"
    assert got["c"]["body"] == "plain text" and got["c"]["parse_status"] == "parsed"
    d = got["d"]
    assert d["parse_status"] == "fallback" and d["subject"] == "broken"
    assert d["sender_email"] == "bad@mail.org" and d["body"].startswith("soft=break")


def test_mail_folders(spark, tmp_path):
    for folder, name, data in (("spam_2", "1", b"a \xe9"), ("easy_ham", "2", b"b"), ("hard_ham/spam-like", "3", b"c")):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / name).write_bytes(data)
    got = {r["message"]: r["label"] for r in FS.mail_folders(spark, str(tmp_path), r"spam_2").collect()}
    assert got == {"a é": 1, "b": 0, "c": 0}


def test_missing_files(spark, tmp_path):
    empty = FS.corpus_csv_or_empty(spark, str(tmp_path / "none.csv"))
    assert empty.count() == 0 and "num_urls" in empty.columns
    assert FS.reputation_csv(spark, str(tmp_path / "none.csv")) is None
    (tmp_path / "short.csv").write_text("domain,category\na.com,spam\n")
    assert FS.reputation_csv(spark, str(tmp_path / "short.csv")) is None


def test_lists(spark, tmp_path):
    (tmp_path / "d.csv").write_text("rank,domain\n1, A.com \n2,a.com\n3,\n")
    assert [r[0] for r in FS.domain_list_csv(spark, str(tmp_path / "d.csv")).collect()] == ["a.com"]
    (tmp_path / "u.txt").write_text("https://www.apple.com/x, google.co.uk\n\n, http://localhost:80\n")
    assert {r[0] for r in FS.safe_hosts(spark, str(tmp_path / "u.txt")).collect()} == {"apple.com", "google.co.uk", "localhost"}


def test_clean_corpus_keeps_line_breaks_out_and_reads_back(spark, frame, tmp_path):
    raw = frame("email_id int, label int, message string",
                (1, 1, 'Subject: "Hi"\nFrom: A <a@b.com>\n\nline one\nhttp://x.com/a [now] ----- end'),
                (2, 1, 'Subject: "Hi"\nFrom: A <a@b.com>\n\nline one\nhttp://x.com/a [now] ----- end'), (3, 0, ""))
    PC.run(raw, str(tmp_path / "c"), "csv")
    rows = {r["label"]: r for r in FS.corpus_csv(spark, str(tmp_path / "c")).collect()}
    assert len(rows) == 2
    assert rows[1]["body"] == "line one http://x.com/a now end" and rows[1]["subject"] == "Hi"
    assert rows[1]["from"] == "a@b.com" and rows[1]["num_urls"] == 1 and rows[0]["num_urls"] == 0


def test_reputation_run(spark, tmp_path):
    RP.run(C.emails(spark, SF), str(tmp_path), C.CORPUS_SUFFIXES)
    full = spark.read.parquet(str(tmp_path / "domain_analysis"))
    good = spark.read.parquet(str(tmp_path / "legitimate_domains"))
    assert good.count() == full.where("legitimacy_score >= 70").count() > 0
    assert spark.read.text(str(tmp_path / "safe_urls")).count() == C.emails(spark, SF).where("label = 0 and urls is not null").count()


@pytest.fixture(scope="module")
def fitted(spark):
    return TR.fit(C.emails(spark, SF))


def test_training(spark, fitted):
    m = fitted.metrics
    assert m["training_rows"] == 200 and m["feature_count"] == len(fitted.feature_names)
    assert 0.5 < m["roc_auc"] <= 1 and 0 <= m["f1"] <= 1
    with pytest.raises(ValueError, match="urls"):
        TR.fit(C.emails(spark, SF).drop("urls"))


def test_gradient_vanishes_at_the_fit(spark, fitted):
    """The loss is the weighted mean log loss plus the ridge term; its slope at the result is near zero."""
    split = O.stratified_split(C.emails(spark, SF), "email_id", "label")
    rows = TR.probabilities(fitted, TR.feature_table(split.where(~F.col("is_test")), ["label"])).select("label", "p", vector_to_array("features").alias("x")).collect()
    x, y, p = np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows]), np.array([r["p"] for r in rows])
    weight = len(y) / (2 * np.where(y == 1, (y == 1).sum(), (y == 0).sum()))
    coefficients = fitted.model.stages[-1].coefficients.toArray()
    slope = x.T @ (weight * (p - y)) / weight.sum() + coefficients / (K.REGULARISATION_C * len(y))
    assert np.abs(slope).max() < 1e-3 and abs((weight * (p - y)).sum() / weight.sum()) < 1e-3
    none = C.emails(spark, SF).withColumn("label", F.when(F.col("email_id") > 2, F.col("label")))
    with pytest.raises(ValueError, match="3 rows have no label"):
        TR.fit(none)


def test_scoring_job_moves_no_text(spark, fitted):
    """Texts end in the signal table: no exchange of the job after it carries a body."""
    mails = C.emails(spark, SF).withColumn("url", F.lit(None).cast("string"))
    sites = spark.createDataFrame([("paypal.com",)], "domain string")
    signals = TR.annotate(fitted, mails)._jdf.queryExecution().executedPlan().toString()
    own = mails._jdf.queryExecution().executedPlan().toString()
    assert signals.count("hashpartitioning") == own.count("hashpartitioning")  # those of the derived test mails only
    job = PS.scored(mails, fitted, sites, sites, None, key="email_id")._jdf.queryExecution().executedPlan().toString()
    assert "body" not in job


def test_saved_model_predicts_the_same(spark, fitted, tmp_path):
    mails = C.emails(spark, SF)
    TR.save(fitted, spark, str(tmp_path))
    again = TR.train_or_load(spark, str(tmp_path), mails.limit(0))  # an empty corpus cannot be trained on
    a = dict(map(tuple, TR.predict(fitted, mails).collect()))
    b = dict(map(tuple, TR.predict(again, mails).collect()))
    assert a == b and len(a) == 200
    assert again.metrics["feature_count"] == fitted.metrics["feature_count"]


def test_batch_and_stream_agree(spark, fitted, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    mails = [{"id": "1", "sender_email": "a@paypa1.com", "subject": "Verify your account", "body": "see http://paypa1.com/x"},
             {"id": "2", "from": "b@c.com", "body": "hello https://c.com/y"}, {"id": "3"}, {"body": "no id http://paypa1.com"}]
    (inbox / "a.json").write_text("\n".join(map(json.dumps, mails[:2])) + "\nnot a json\n")
    (inbox / "b.json").write_text("\n".join(map(json.dumps, mails[2:])) + "\n")
    trusted = spark.createDataFrame([("paypal.com",)], "domain string")
    none = spark.createDataFrame([], "domain string")

    def job(batch):
        return PS.scored(batch, fitted, trusted, none, None).select(
            "id", "final_label", "overall_score", "urls", "lookalikes", "model_probability", "model_indicators", "model_name", "model_threshold",
            F.map_keys("model_metrics").alias("metrics"))

    good, bad = PS.split_requests(FS.mail_requests_json(spark, str(inbox)))
    batch = {r["id"]: r for r in job(good).collect()}
    query = ST.score_stream(ST.mail_stream(spark, str(inbox)), job, str(tmp_path / "out"), str(tmp_path / "dead"), str(tmp_path / "ck"))
    query.awaitTermination(240)
    stream = {r["id"]: r for r in spark.read.parquet(str(tmp_path / "out")).drop("batch").collect()}
    assert stream == batch and set(batch) == {"1", "2", "3", None}
    assert batch[None]["urls"] == ["paypa1.com"] and batch[None]["final_label"] == "Spam"
    assert batch["3"]["model_indicators"] == [] and batch["1"]["model_threshold"] == 0.42 and "roc_auc" in batch["1"]["metrics"]
    assert batch["1"]["lookalikes"][0]["closest"] == "paypal.com"
    assert (batch["3"]["final_label"], batch["3"]["model_probability"]) == ("Safe", 0.0)
    dead = spark.read.json(str(tmp_path / "dead")).collect()
    assert [r["final_label"] for r in dead] == ["Error"] and "not a json" in dead[0]["error"]
    assert len(bad.collect()) == 1 and PS.rejected(good).count() == 1
    marked = PS.with_highlights(PS.scored(good, fitted, trusted, none, None), good)
    assert "<span" in {r["id"]: r["subject_highlighted"] for r in marked.collect()}["1"]


def test_scores_as_json(spark, tmp_path):
    row = SK.as_json(spark.createDataFrame([(1, None, [True])], "id int, a string, f array<boolean>"), "id").first()
    assert json.loads(row["json"]) == {"id": 1, "a": None, "f": [True]}


def test_long_runs_do_not_hang_or_overflow(spark):
    rows = spark.createDataFrame([("a" * 200_000,), ("http://" + "a." * 20_000 + "com",), ("http://" + "a." * 20_000,)], "t string")
    got = rows.select(F.size(U.text_domains(F.col("t"))).alias("n"), U.body_domains(F.col("t")).alias("d")).collect()
    assert [r["n"] for r in got] == [0, 1, 1]
    assert got[1]["d"] == ["a.com"]
