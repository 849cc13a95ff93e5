import pytest

from foldloom.operators.cleaning import corpus_gate, drop_failed_corpora, kept_rows, reject_report, tag_rows
from foldloom.operators.labels import relabel_by_table, relabel_drop, relabel_keep, unmapped_report, whitelist
from foldloom.plans.corpus import build_corpora
from foldloom.plans.registry import BY_NAME, SPECS
from foldloom.plans.spec import CorpusSpec
from pyspark.sql import functions as F


def clean(spark, name, rows, **changes):
    """Rows of the spec's columns, cleaned: the kept (text, label) pairs and the reasons of the others."""
    import dataclasses

    spec = dataclasses.replace(BY_NAME[name], **changes)
    schema = "row_id bigint, " + ", ".join(f"`{c}` string" for c in spec.columns)
    raw = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], schema)
    tagged = tag_rows(raw, spec)
    kept = [tuple(r) for r in kept_rows(tagged).orderBy("row_id").select("text", "label").collect()]
    reasons = [r[0] for r in tagged.orderBy("row_id").select("reject_reason").collect() if r[0]]
    return kept, reasons


def test_the_registry_has_fifteen_corpora():
    assert len({(s.task, s.corpus) for s in SPECS}) == 15
    assert [s.corpus for s in SPECS if s.fold_rule == "stratified"] == ["RulingBRCorpus", "IntentPTCorpus"]
    assert sum(s.has_closed_labels for s in SPECS) == 12


def test_first_of_many_categories(spark):
    rows = [("a", "lazer, comida"), (" b ", " bar "), ("c", ",x"), (None, "x"), ("d", None), ("  ", "x")]
    kept, reasons = clean(spark, "EniacCorpus", rows)
    assert kept == [("a", "lazer"), (" b ", "bar"), ("  ", "x")]
    assert reasons == ["blank_label", "null_text", "null_label"]


def test_subjects_without_a_name_stay(spark):
    kept, _ = clean(spark, "MMLU_PTBR_Corpus", [("q", "anatomy"), ("r", "cooking"), ("s", None)])
    assert kept == [("q", "anatomia"), ("r", "cooking")]


def test_sections_without_a_name_go_and_some_merge(spark):
    kept, reasons = clean(spark, "RecognasummCorpus", [("n", "saúde"), ("m", "VIVA BEM"), ("o", "viva bem"), ("p", "Mundo")])
    assert kept == [("n", "saúde e bem-estar"), ("m", "saúde e bem-estar"), ("p", "notícia internacional")]
    assert reasons == ["label_unmapped"]


def test_law_areas_are_a_whitelist(spark):
    kept, reasons = clean(spark, "RulingBRCorpus", [("e", "direito civil"), ("f", "Direito Civil"), ("g", "direito econômico")])
    assert kept == [("e", "direito civil"), ("g", "direito econômico")] and reasons == ["label_not_admitted"]


@pytest.mark.parametrize("name", ["HateBRCorpus", "TuPyCorpus"])
def test_offense_codes(spark, name):
    kept, reasons = clean(spark, name, [("a", "0"), ("b", "1.0"), ("c", "2"), ("d", None), ("e", "-0.5"), ("f", "x"), (None, "x")])
    assert kept == [("a", "Não Ofensivo"), ("b", "Ofensivo"), ("e", "Não Ofensivo")]
    assert reasons == ["label_not_admitted", "null_label", "not_an_integer", "null_text"]


def test_court_decisions(spark):
    kept, _ = clean(spark, "CourtDecisionCorpus", [("a", "yes"), ("b", "no"), ("c", "partial"), ("d", "Yes"), ("e", "maybe")])
    assert kept == [("a", "recurso provido"), ("b", "recurso não provido"), ("c", "recurso parcialmente provido")]


def test_intents_keep_empty_texts(spark):
    kept, _ = clean(spark, "IntentPTCorpus", [("oi", "general_greet"), ("", "play_game"), ("x", "other"), (None, "play_game")])
    assert kept == [("oi", "saudação"), ("", "jogar"), ("x", "other")]


@pytest.mark.parametrize("name", ["B2WReviewsCorpus", "BrandsCorpus", "ReProCorpus"])
def test_star_reviews_with_titles(spark, name):
    # The order of columns is that of the spec: text, label, title.
    rows = [
        ("bom", "5", "Ótimo"), (None, "1", "Ruim"), ("ok", "2.9", None), (None, "4", None), (" \xa0", "4", "\t"),
        ("x", "3", "y"), ("x", "cinco", "y"), ("x", None, "y"), ("x", "inf", "y"), ("x", "4.7", "y"),
    ]
    kept, reasons = clean(spark, name, rows)
    assert kept == [("Ótimo bom", "Positivo"), ("Ruim", "Negativo"), ("ok", "Negativo"), ("y x", "Positivo")]
    assert reasons == ["blank_text", "blank_text", "label_not_admitted", "not_a_number", "null_label", "not_a_number"]


def test_star_reviews_without_titles(spark):
    kept, reasons = clean(spark, "UTLCorpus", [(" a\n", "5"), (None, "5"), ("　", "1"), ("b", "1")])
    assert kept == [("a", "Positivo"), ("b", "Negativo")] and reasons == ["null_text", "blank_text"]


@pytest.mark.parametrize("name", ["OlistCorpus", "BuscapeCorpus"])
def test_polar_reviews(spark, name):
    kept, reasons = clean(spark, name, [(" a ", "1"), ("b", "0.0"), (None, "1"), ("c", "2"), ("d", "")])
    assert kept == [("a", "Positivo"), ("b", "Negativo")]
    assert reasons == ["blank_text", "label_not_admitted", "not_a_number"]


def test_tweets_are_not_stripped_and_null_texts_are_an_option(spark):
    rows = [(" a ", "Positivo"), ("b", "positivo"), (None, "Negativo"), ("  ", "Negativo")]
    assert clean(spark, "KaggleTweetsCorpus", rows)[0] == [(" a ", "Positivo"), ("  ", "Negativo")]
    old = clean(spark, "KaggleTweetsCorpus", rows, null_text="nan")[0]
    assert old == [(" a ", "Positivo"), ("nan", "Negativo"), ("  ", "Negativo")]


SPEC = CorpusSpec("hate", "c", [], "text", "label", label_rule="strict_integer", labels={0: "no", 1: "yes"})


def tagged_corpora(spark):
    rows = [
        ("good", "a", "0", None), ("good", "b", "7", None), ("bad", "a", "x", None), ("bad", "b", "1", None),
        ("empty", "a", "9", None), ("empty", None, "x", None), ("long", "a", "x", "ragged"), ("long", "b", "1", None),
    ]
    raw = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id bigint, corpus string, text string, label string, fault string")
    return tag_rows(raw, SPEC).join(raw.select("row_id", "corpus"), "row_id")


def test_gate(spark):
    tagged = tagged_corpora(spark)
    status = {r.corpus: (r.rows_in, r.rows_kept, r.status) for r in corpus_gate(tagged).collect()}
    assert status == {
        "good": (2, 1, "OK"), "bad": (2, 1, "BAD_LABEL_TYPE"), "empty": (2, 0, "EMPTY"), "long": (2, 1, "RAGGED")
    }
    assert [(r.corpus, r.text, r.label) for r in drop_failed_corpora(tagged).collect()] == [("good", "a", "no")]
    report = {(r.corpus, r.reason): r.n_rows for r in reject_report(tagged, ["corpus"]).collect()}
    assert report[("good", "kept")] == 1 and report[("empty", "null_text")] == 1 and report[("long", "ragged")] == 1


def test_corpora_of_different_fold_rules_are_refused(spark):
    raw = spark.createDataFrame([(1, "a", "0")], "row_id bigint, text string, label string")
    other = CorpusSpec("intent", "d", [], "text", "label", fold_rule="stratified")
    with pytest.raises(ValueError):
        build_corpora([(SPEC, raw), (other, raw)])


def test_label_tables(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "A"), (3, "b"), (4, None), (5, "c")], "id int, label string")
    names = {"a": "x", "b": "x"}
    pairs = lambda df: sorted(((r.id, r.label) for r in df.collect()), key=lambda p: p[0])
    assert pairs(whitelist(rows, ["a", "c"])) == [(1, "a"), (5, "c")]
    kept = [(1, "x"), (2, "A"), (3, "x"), (4, None), (5, "c")]
    assert pairs(relabel_keep(rows, names)) == kept
    assert pairs(relabel_drop(rows, names)) == [(1, "x"), (3, "x")]
    table = spark.createDataFrame(list(names.items()), "raw string, label string")
    for fits in (None, True, False):
        assert pairs(relabel_by_table(rows, table, fits=fits)) == kept
        assert pairs(relabel_by_table(rows, table, keep_unmapped=False, fits=fits)) == [(1, "x"), (3, "x")]
    assert {(r.label, r.n_rows) for r in unmapped_report(rows, names).collect()} == {("A", 1), ("c", 1)}
    assert rows.where(F.col("label").isNull()).count() == 1
