"""Jobs without SQL: models, files, streams."""

import pytest
from pyspark.sql import functions as F

from wordloom.operators import correct, corpus, evaluate as ev, models
from wordloom.plans import inputs
from wordloom.plans.catalog import QUERIES
from wordloom.sources import files, tables
from wordloom.staging import fresh_path


def test_training_flow(spark, sf):
    rows, encoders, scaler = inputs.prepared(spark, sf, fit_on="train")
    xy = models.load_xy(rows).cache()
    trained = models.train_all(xy, len(inputs.CLASSES), "smoke", 1)
    preds = models.all_predictions({n: m for n, (m, _) in trained.items()}, xy)
    table = ev.compare(preds).toPandas()
    assert set(table.model) == {"random_forest", "boost_searched", "boost_fixed", "ensemble"}
    assert table.val_f1.between(0.4, 1).all()
    boost = trained["boost_fixed"][0]
    long = models.probability_rows(models.predictions(boost, xy, "b"))
    sums = long.groupBy("id").agg(F.sum("p").alias("s")).where(F.abs(F.col("s") - 1) > 1e-9)
    assert sums.count() == 0
    path = fresh_path(spark, "models")
    for name, (model, _) in trained.items():
        models.save_model(model, f"{path}/{name}")
    back = models.load_models(path, ["absent", *trained])
    assert set(back) == set(trained)
    again = models.predictions(back["boost_fixed"], xy, "b").select("id", "prediction")
    assert again.exceptAll(models.predictions(boost, xy, "b").select("id", "prediction")).count() == 0
    assert models.importance(back["random_forest"], spark).count() == 28
    typer = models.ErrorTyper(boost, encoders, scaler)
    pairs = spark.createDataFrame([("would", "woould"), ("would", "wuld")], "correct_word string, incorrect_word string")
    typed = {r.incorrect_word: r for r in models.error_types(pairs, typer).collect()}
    assert typed["woould"].error_type == "insertion" and typed["wuld"].error_type == "deletion"
    assert abs(sum(typed["wuld"].probabilities.values()) - 1) < 1e-9
    # A saved bundle types alike, and corrections carry the types.
    typer.save(f"{path}/typer")
    loaded = models.ErrorTyper.load(spark, f"{path}/typer")
    assert {r.incorrect_word: r.error_type for r in models.error_types(pairs, loaded).collect()} == {k: r.error_type for k, r in typed.items()}
    known = spark.createDataFrame([("would", 900), ("go", 500)], "word string, freq bigint")
    asked = spark.createDataFrame([("Woould",), ("go",), ("",)], "word string")
    answers = {r.word: r for r in correct.check_words(asked, known, typer=loaded).collect()}
    assert answers["Woould"].error_type == "insertion" and answers["Woould"].confidence > 0.25
    assert answers["go"].error_type is None and answers[""].probabilities is None
    said = spark.createDataFrame([(1, "I wuld go."), (2, "go")], "id int, sentence string")
    lines = {r.id: r for r in correct.check_sentences(said, ["id"], known, typer=loaded).collect()}
    assert lines[1].corrected_sentence == "I would go." and lines[1].errors[0].error_type == "deletion" and lines[2].errors == []


def test_absent_class_gets_no_probability(spark, sf):
    xy = models.load_xy(inputs.prepared(spark, sf)[0]).where(F.col("label") != 1)
    model = models.PerClassBoost(4, maxIter=2, maxDepth=2).fit(xy)
    assert models.predictions(model, xy, "m").where(F.get("probabilities", F.lit(1)) > 0).count() == 0


def test_xml_reader(spark):
    path = fresh_path(spark, "xml")
    text = """<mediawiki xmlns="http://example.org/export/">
<page><title>A</title><id>1</id><revision><id>7</id><text bytes="3" xml:space="preserve">a &amp; b</text></revision></page>
<page><title>B</title><id>2</id><text>plain</text></page>
<page><title>E</title><id>5</id><revision><text>first</text></revision><revision><text>second</text></revision></page>
<page><title>C</title><id>3</id><revision></page>
<page><title>D</title><id>4</id><revision><text/></revision></page>
</mediawiki>"""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    rows = {r.doc_id: (r.title, r.text) for r in files.read_wiki_xml(spark, path).collect()}
    assert rows[1] == ("A", "a & b") and rows[2] == ("B", "plain")
    assert not rows.get(4, (None, None))[1]
    assert rows[5] == ("E", "first")
    assert rows[3] == ("C", None)  # damaged, but its title was found


def test_pretty_printed_map(spark):
    path = fresh_path(spark, "json")
    text = '{\n  "the": 12,\n  "a\\u00e9b": 3,\n  "q\\"x": 4\n}'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    assert {(r.word, r.freq) for r in files.read_freq_map(spark, path).collect()} == {("the", 12), ("aéb", 3), ('q"x', 4)}


def test_dictionary_file_is_in_rank_order(spark):
    path = fresh_path(spark, "dict")
    vocab = spark.range(500).select(F.concat(F.lit("w"), "id").alias("word"), (F.col("id") * 31 % 97).alias("freq"))
    from wordloom.staging import stage

    files.write_dictionary(stage(vocab, "v"), path, 300)
    parts = sorted(r.f for r in spark.read.text(path).select(F.input_file_name().alias("f")).distinct().collect())
    lines = [r.value for p in parts for r in spark.read.text(p).collect()]
    want = [r.word for r in vocab.orderBy(F.desc("freq"), "word").limit(300).collect()]
    assert lines == want


def test_snapshots(spark, sf):
    articles = tables.articles(spark, sf)
    shots = corpus.snapshots(articles, every=50)
    n = corpus.count_accepted(articles).first().articles
    assert {r.articles for r in shots.select("articles").distinct().collect()} == set(range(50, n + 1, 50))
    grown = shots.groupBy("word").agg(F.max_by("freq", "articles").alias("last"), F.max("freq").alias("most"))
    assert grown.where("last <> most").count() == 0


@pytest.mark.parametrize("name", ["cor_error_type", "cor_word_typed", "cor_sentence_typed"])
def test_typed_corrections_count_the_corpus_once(spark, tmp_path, monkeypatch, name):
    """Dictionary and training data come from one staged vocabulary."""

    class Training(Exception):
        pass

    def stop(*args, **kwargs):
        raise Training

    text = "some plain words of a text that is long enough to count " * 4
    spark.createDataFrame([(1, text, "en", "src9", len(text))], tables.SCHEMAS["documents"]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, "user", "som plain wrds")], tables.SCHEMAS["conversations"]).write.parquet(f"{tmp_path}/conversations.parquet")
    counted, count = [], inputs.vocab
    monkeypatch.setattr(inputs, "vocab", lambda *args: counted.append(args) or count(*args))
    monkeypatch.setattr(inputs.synth, "build_dataset", stop)
    with pytest.raises(Training):
        QUERIES[name](spark, str(tmp_path))
    assert len(counted) == 1
