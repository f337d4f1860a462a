import json

import pytest
from pyspark.sql import functions as F

from threadlens.functions import prompts as pr
from threadlens.functions import responses as rs
from threadlens.operators import classify as cl
from threadlens.operators import evaluate as ev
from threadlens.operators import features as fe
from threadlens.operators import labels as lb
from threadlens.operators import retrieve as rt
from threadlens.plans import agent as ag
from threadlens.streaming import resume


def test_published_escalation_rates(spark):
    cells = spark.createDataFrame([(14, 80, 1, 105)], "tp long, fn long, fp long, tn long")
    found = ev.binary_metrics(cells).first()
    assert [round(found[m], 3) for m in ("precision", "recall", "f1")] == [0.933, 0.149, 0.257]


def test_published_p_values(spark):
    rows = [("correctness", 25, 0.406), ("tone", 25, 0.815), ("actionability", 25, 0.338), ("overall", 25, 0.614)]
    found = ev.with_p_value(spark.createDataFrame(rows, "dimension string, n long, rho double")).collect()
    assert {r["dimension"]: round(r["p_value"], 3) for r in found} == {
        "correctness": 0.044, "tone": 0.0, "actionability": 0.098, "overall": 0.001}


def test_spearman_without_variance_or_with_a_gap_is_null(spark):
    flat = spark.createDataFrame([("d", float(i), 3.0) for i in range(5)], "dimension string, human double, judge double")
    assert ev.spearman(flat).first()["rho"] is None
    gap = spark.createDataFrame(
        [("d", 1.0, 1.0), ("d", 2.0, 2.0), ("d", 3.0, 5.0), ("d", 4.0, None)], "dimension string, human double, judge double")
    assert ev.spearman(gap).first()["rho"] is None
    assert ev.spearman(gap, skip_missing=True).first()["rho"] == pytest.approx(1.0)


def test_empty_decisions_score_zero(spark):
    none = spark.createDataFrame([], "gold_escalate string, escalate string")
    good, _ = ev.readable_decisions(none, "gold_escalate", "escalate")
    found = ev.binary_metrics(ev.confusion(good)).first()
    assert (found["precision"], found["recall"], found["f1"]) == (0.0, 0.0, 0.0)


def test_a_predicted_label_without_gold_counts_in_the_macro_average(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "other")], "gold string, pred string")
    macro = ev.classification_report(df, "gold", "pred").filter("label = 'macro avg'").first()
    assert macro["f1"] == pytest.approx(1 / 3)


def test_incomplete_labels_are_refused(spark):
    sheet = spark.createDataFrame([("g0",), ("g1",)], "example_id string")
    labels = spark.createDataFrame([("g0", "a", "True", "", "")], "example_id string, gold_intent string, "
                                   "gold_escalate string, escalate_reason string, labeler_notes string")
    with pytest.raises(ValueError, match="1 rows"):
        lb.require_complete(lb.merge_labels(sheet, labels))


@pytest.mark.parametrize("raw, reply, escalate", [
    ('{"reply": "r", "escalate": false}', "r", False),
    ('```json\n{"reply": "r", "escalate": true}\n```', "r", True),
    ('  ```\n{"reply": "r", "escalate": false}\n```  ', "r", False),
    ("{}", None, None), ("", None, True), (None, None, True), ("no json", None, True),
    ('{"reply": "r", "escalate": "maybe"}', None, True),
    ('{"reply": "r", "escalate": false} Hope that helps!', None, True), ("{'reply': 'r', 'escalate': false}", None, True),
    ('```json\n{"reply": "r", "escalate": false}\n```\nLet me know', None, True), ('{"reply": "r", "escalate": false', None, True),
])
def test_agent_answers(spark, raw, reply, escalate):
    df = spark.createDataFrame([(raw,)], "raw string")
    found = df.select(rs.agent_answer(F.col("raw")).alias("a")).select("a.*").first()
    assert (found["reply"], found["escalate"]) == (reply, escalate)


def test_labels_in_answers(spark):
    df = spark.createDataFrame([("Battery Drain",), ("it is screen_issue!",), ("other",), ("?",), (None,)], "raw string")
    found = df.select(rs.match_label(F.col("raw"), ["screen_issue", "battery_drain"])).collect()
    assert [r[0] for r in found] == ["battery_drain", "screen_issue", "other", "other", "other"]


def test_exemplar_block(spark):
    kind = "e array<struct<customer_text:string,brand_text:string>>"
    df = spark.createDataFrame([([("c1", "b1"), ("c2", "b2")],), ([],), (None,)], kind)
    found = [r[0] for r in df.select(pr.exemplar_block(F.col("e"))).collect()]
    assert found[0] == (pr.EXEMPLAR_HEADING + '\n1. Customer: "c1"\n   Brand replied: "b1"\n2. Customer: "c2"\n   Brand replied: "b2"')
    assert found[1] == found[2] == pr.NO_EXEMPLARS


def test_agent_end_to_end(spark):
    pool = spark.createDataFrame(
        [(f"c{i}", f"b{i}", text, intent, f"answer {i}") for i, (text, intent) in enumerate(
            [("battery drains fast", "power"), ("battery drains at night", "power"),
             ("screen is black", "display"), ("black screen again", "display")] * 3)],
        "customer_tweet_id string, brand_tweet_id string, customer_text string, intent string, brand_text string")
    classifier = cl.fit_classifier(pool, "customer_text", fe.TextOptions(min_df=1))
    retriever = rt.Retriever(pool, fe.TextOptions(min_df=1), exclude=None)
    messages = spark.createDataFrame(
        [("e1", "battery drains", None), ("e2", "screen black", "hello"), ("e3", None, None), ("e4", "zzz", None)],
        "example_id string, customer_text string, prior_context string")

    def answer(prompt: str) -> str:
        if "(No closely" in prompt:
            return "not json"
        return json.dumps({"reply": "try this", "escalate": "hello" in prompt, "escalate_reason": "r"})

    found = {r["example_id"]: r for r in ag.run_agent(
        messages, "example_id", "the brand", classifier, retriever, answer, "stub", "Hand over what is unclear.").collect()}
    assert set(found) == {"e1", "e2", "e4"}
    assert (found["e1"]["intent"], found["e1"]["num_exemplars_found"], found["e1"]["escalate"]) == ("power", 3, False)
    assert (found["e2"]["intent"], found["e2"]["escalate"]) == ("display", True)
    assert (found["e4"]["num_exemplars_found"], found["e4"]["escalate"]) == (0, True)
    assert found["e4"]["escalate_reason"] == rs.UNPARSED_AGENT and found["e1"]["model_name"] == "stub"


def test_resumed_runs_do_each_row_once(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(20).withColumnRenamed("id", "example_id")
    tag = lambda name: lambda df: df.withColumn("run", F.lit(name))
    resume.append_new(rows.filter("example_id < 5"), path, "example_id", tag("first"))
    resume.append_new(rows, path, "example_id", tag("second"), commits=3)
    runs = {r["run"]: r["count"] for r in spark.read.parquet(path).groupBy("run").count().collect()}
    assert runs == {"first": 5, "second": 15}
    resume.append_new(rows, path, "example_id", tag("third"), restart=True, commits=2)
    assert {r["run"]: r["count"] for r in spark.read.parquet(path).groupBy("run").count().collect()} == {"third": 20}


def test_a_stopped_run_goes_on_where_it_was(spark, tmp_path, monkeypatch):
    """Stopped in its third part, a run under the same name reads and does only what is left."""
    path = str(tmp_path / "out")
    rows = spark.range(200).withColumnRenamed("id", "example_id")
    tag = lambda name: lambda df: df.withColumn("run", F.lit(name))
    resume.append_new(rows.filter("example_id < 50"), path, "example_id", tag("old"), restart=True, commits=5)
    done = []

    def stopped(df):
        done.append(len(done))
        if len(done) == 3:
            raise KeyboardInterrupt
        return tag("first")(df)

    with pytest.raises(KeyboardInterrupt):
        resume.append_new(rows, path, "example_id", stopped, run="nightly")
    read, whole = [], resume.finished
    monkeypatch.setattr(resume, "finished", lambda s, p, k: read.append(p.rsplit("=")[-1]) or whole(s, p, k))
    resume.append_new(rows, path, "example_id", tag("second"), run="nightly")
    assert read == ["2", "3", "4"]  # each part once, and none that was finished
    out = resume.output(spark, path)
    assert sorted(r["example_id"] for r in out.collect()) == list(range(200)) and out.columns == ["example_id", "run"]
    runs = {r["run"]: r["count"] for r in out.groupBy("run").count().collect()}
    assert runs["old"] == 50 and runs["first"] > 20 and runs["second"] > 40
    resume.append_new(rows, path, "example_id", tag("third"), run="nightly")
    assert resume.output(spark, path).count() == 200


def test_a_part_is_dealt_by_many_tasks(spark, tmp_path, monkeypatch):
    """Two parts of one table: no task gets the half of it."""
    staged = str(tmp_path / "dealt")
    monkeypatch.setattr(resume, "scratch_path", lambda *_: staged)
    monkeypatch.setattr(resume, "pending", lambda rows, *_: rows)
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        resume.append_new(spark.range(4_000), str(tmp_path / "out"), "id", lambda df: df, commits=2)
    finally:
        spark.conf.unset(merge)
    sizes = [r["count"] for r in spark.read.parquet(staged).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 4_000 and max(sizes) < 800


def test_rows_without_an_id_are_done_once(spark, tmp_path):
    path = str(tmp_path / "nameless")
    rows = spark.createDataFrame([(None, "x"), (None, "a"), ("b", "y")], "example_id string, body string")
    for _ in range(2):
        resume.append_new(rows, path, "example_id", lambda df: df)
    assert sorted((r["example_id"] or "", r["body"]) for r in resume.output(spark, path).collect()) == [("", "a"), ("b", "y")]


def test_a_stream_keeps_ids_in_its_state(spark, tmp_path):
    """Files that come later repeat ids; a batch that is run again overwrites its own folder."""
    path, source, progress = (str(tmp_path / n) for n in ("out", "in", "progress"))
    for first, last in ((0, 30), (20, 50), (10, 60)):
        spark.range(first, last).coalesce(1).write.mode("append").parquet(source)
        resume.append_stream(spark, source, "id bigint", path, "id", lambda df: df, progress, files_per_batch=1)
    assert sorted(r["id"] for r in resume.output(spark, path).collect()) == list(range(60))


def test_a_repeated_id_is_done_once(spark, tmp_path):
    path = str(tmp_path / "repeated")
    rows = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "example_id string, body string")
    resume.append_new(rows, path, "example_id", lambda df: df)
    assert sorted(r["example_id"] for r in spark.read.parquet(path).collect()) == ["a", "b"]


def test_a_failing_answer_becomes_null(spark):
    from threadlens.operators.scoring import score_texts

    def answer(prompt: str) -> str:
        if prompt == "bad":
            raise RuntimeError("no answer")
        return prompt.upper()

    rows = spark.createDataFrame([("ok",), ("bad",), (None,)], "prompt string")
    found = {r["prompt"]: (r["response"], r["response_error"]) for r in score_texts(rows, "prompt", answer, "stub").collect()}
    assert found == {"ok": ("OK", None), "bad": (None, "RuntimeError: no answer"), None: (None, None)}


def test_white_space_of_any_kind_is_trimmed(spark):
    from threadlens.functions.scalars import first_listed_id, to_bool

    df = spark.createDataFrame([("True\n", "\t12\n,13")], "a string, b string")
    assert tuple(df.select(to_bool(F.col("a")), first_listed_id(F.col("b"))).first()) == (True, "12")
