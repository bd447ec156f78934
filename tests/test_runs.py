import io
import zipfile

import pytest
from pyspark.sql import functions as F

from verbalis.params import TrainingParams
from verbalis.plans import data as D
from verbalis.plans.training import AutoTextClassifier, load_model, score
from verbalis.plans.fixtures import workbook
from verbalis.sources import tables
from verbalis.sources.workbooks import sheet_rows
from verbalis.streaming.scoring import read_text_stream, score_stream

PARAMS = TrainingParams(
    label_col_name="lang", number_of_records_to_include=1.0, min_records_per_class=15, lemmas_freq_requirement=8,
    bi_cols_freq_requirement=5, tri_cols_freq_requirement=4, model_selection_cv_folds_count=2, n_promising_models_to_select=1,
    n_hyperparam_combos=1, model_tuning_cv_folds_count=2,
)


@pytest.fixture(scope="module")
def run(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("run") / "saved")
    docs = D.documents(spark, sf).drop("source")
    result = AutoTextClassifier(PARAMS, D.lexicons(spark, sf), ("logistic", "decision_tree"), {"logistic": {"max_iter": 30}}).fit(docs, path)
    return result, docs, path


def test_run_beats_the_majority_class(run):
    result, docs, _ = run
    best = result.evaluation.first()
    share = docs.filter("lang = 'en'").count() / docs.count()
    majority_f1 = 2 * share / (1 + share) / len(result.labels)
    assert best.f1_macro > majority_f1 + 0.2


def test_report_cuts_long_values(run):
    result, _, _ = run
    report = result.report().collect()
    sections = {f"{stage}{part}" for stage in ("selection", "evaluation") for part in ("", "_confusion", "_report")}
    assert {r.section for r in report} == {"parameters", "metadata", "best"} | sections
    assert max(len(r.value) for r in report) <= 40


def test_saved_model_predicts_the_same(spark, run):
    result, docs, path = run
    ours = score(result.model, docs).select("doc_id", "predicted_label")
    theirs = score(load_model(path), docs).select("doc_id", "predicted_label")
    assert ours.exceptAll(theirs).count() == 0 and theirs.count() == docs.count()
    assert spark.read.parquet(f"{path}/vocab").count() == result.facts["term_count"]


def test_one_row_scores_like_a_batch(run):
    result, docs, _ = run
    batch = {r.doc_id: r.prediction for r in score(result.model, docs).collect()}
    for row in docs.limit(3).collect():
        single = score(result.model, docs.filter(F.col("doc_id") == row.doc_id)).first()
        assert single.prediction == batch[row.doc_id]


def test_stream_equals_batch(spark, sf, run, tmp_path):
    result, _, _ = run
    turns = D.table(spark, sf, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("doc_id"), "text")
    turns.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = read_text_stream(spark, str(tmp_path / "in"), turns.schema, files_per_trigger=1)
    score_stream(result.model, stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out")).select("doc_id", "predicted_label")
    batch = score(result.model, turns).select("doc_id", "predicted_label")
    assert streamed.count() == turns.count() and streamed.exceptAll(batch).count() == 0


def test_voter(run):
    result, docs, _ = run
    assert score(result.voter("hard"), docs).filter("predicted_label IS NULL").count() == 0


def test_unreachable_minimum_leaves_no_model(spark, sf):
    settings = {"label_col_name": "source", "min_records_per_class": 5, "final_min_performance": 1.0, "model_selection_min_performance": 0.0}
    params = TrainingParams.of({**PARAMS.__dict__, **settings})
    docs = D.documents(spark, sf).drop("lang")
    result = AutoTextClassifier(params, D.lexicons(spark, sf), ("decision_tree",)).fit(docs)
    assert result.model is None and result.best is None
    with pytest.raises(ValueError):
        result.save("/tmp/never")


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'say "hi", all', "a"), (2, "two\nlines", "b"), (3, "  spaced  ", "a")]
    df = spark.createDataFrame(rows, "id int, text string, label string")
    tables.write_csv(df, str(tmp_path / "in.csv"), header=True)
    back = tables.read_labelled(spark, str(tmp_path / "in.csv"), "text", "label", "id")
    assert sorted((int(r.id), r.text, r.label) for r in back.collect()) == rows
    with pytest.raises(ValueError):
        tables.read_labelled(spark, "some.json", "text", "label")


def test_xlsx_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"b.{i}.xlsx").write_bytes(workbook(["text", "extra", "label"], [(f"t{i} <&> _x0041_\x07", 1, "l")]))
    back = tables.read_labelled(spark, str(tmp_path), "text", "label", fmt="xlsx").collect()
    assert sorted(r.text for r in back) == [f"t{i} <&> _x0041_\x07" for i in range(3)]
    one = tables.read_labelled(spark, str(tmp_path / "b.1.xlsx"), "text", "label").collect()
    assert len(one) == 1 and one[0].label == "l"


def test_shared_strings_and_gaps():
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as book:
        book.writestr("xl/sharedStrings.xml", "<sst><si><t>text</t></si><si><r><t>ri</t></r><r><t>ch</t></r></si></sst>")
        book.writestr(
            "xl/worksheets/sheet1.xml",
            "<worksheet><sheetData><row><c r='A1' t='s'><v>0</v></c><c r='C1'><v>5</v></c></row>"
            "<row><c r='B2' t='s'><v>1</v></c></row></sheetData></worksheet>",
        )
    assert list(sheet_rows(data.getvalue())) == [["text", None, "5"], [None, "rich"]]
