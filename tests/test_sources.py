"""Damaged inputs, scans that stop, result files."""

from pyspark.sql import Observation, functions as F

from wordloom.operators import corpus
from wordloom.plans import inputs
from wordloom.sources import files, results, tables
from wordloom.staging import fresh_path, stage


def written(spark, text, name="xml"):
    path = fresh_path(spark, name)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def test_pages_behind_a_damaged_one_survive(spark):
    pages = [f"<page><title>T{i}</title><id>{i}</id><revision><text>text &amp; {i}</text></revision></page>" for i in range(10)]
    pages[3] = "<page><title>T3</title><id>3</id><revision><text>broken & <b> 3</revision></page>"
    path = written(spark, "<mediawiki>\n" + "\n".join(pages) + "\n</mediawiki>")
    damage = Observation("damage")
    rows = {r.doc_id: (r.title, r.text) for r in files.read_wiki_xml(spark, path, damage=damage).collect()}
    assert set(rows) == set(range(10)) and rows[9] == ("T9", "text & 9")
    assert rows[3] == ("T3", "broken & ")
    assert damage.get == {"pages": 10, "salvaged": 1, "lost": 0}


def test_pages_without_an_end(spark):
    path = written(spark, """<mediawiki><siteinfo>x</siteinfo>
<page><title>A</title><id>1</id><revision><text>one</text></revision>
<page><title>B &lt;b&gt; &amp;amp;</title><id>2</id><revision><text xml:space="preserve">two</text></revision></page>
<page><id>3</id><titel>C<revision><text>three</text></page>
<page id="x"><title>D</title><id>4</id><revision><text bytes="0" /></revision></page>
<page><title>E</title><id>5</id><revision><text>cut off &quot;he""")
    rows = {r.doc_id: (r.title, r.text, r.state) for r in files.read_wiki_pages(spark, path).collect()}
    assert rows == {
        1: ("A", "one", "salvaged"), 2: ("B <b> &amp;", "two", "intact"), 3: (None, "three", "lost"), 4: ("D", rows[4][1], "intact"),
        5: ("E", 'cut off "he' if rows[5][1].endswith("he") and '"' in rows[5][1] else rows[5][1], "salvaged"),
    }
    assert not rows[4][1] and rows[5][1].startswith("cut off ")
    assert {r.doc_id for r in files.read_wiki_xml(spark, path).collect()} == {1, 2, 4, 5}


def test_prefixed_tags_and_nothing(spark):
    path = written(spark, "<w:mediawiki xmlns:w='u'><w:page><w:title>A</w:title><w:id>1</w:id><w:revision><w:text>one</w:text></w:revision></w:page></w:mediawiki>")
    rows = files.read_wiki_pages(spark, path, "w:page").collect()
    assert [(r.doc_id, r.title, r.text) for r in rows] == [(1, "A", "one")]
    assert files.read_wiki_pages(spark, written(spark, "<mediawiki></mediawiki>")).count() == 0


def test_large_dump_is_read_in_splits(spark):
    path = fresh_path(spark, "large-xml")
    page = F.concat(F.lit("<page><title>T</title><id>"), F.col("id").cast("string"), F.lit("</id><revision><text>"), F.repeat(F.lit("word "), 200), F.lit("</text></revision></page>"))
    spark.range(0, 8_000, 1, 1).select(page.alias("value")).write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        pages = files.read_wiki_pages(spark, path)
        assert files.page_records(spark, path).rdd.getNumPartitions() >= 6
        assert pages.agg(F.countDistinct("doc_id"), F.count("*"), F.count_if(F.col("state") == "intact")).first() == (8_000, 8_000, 8_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rejected_lines(spark):
    lines = ["id,correct_word,incorrect_word,error_type,edit_distance,word_length,word_frequency", "1,the,teh,substitution,1,3,9",
             "2,the,teh,substitution,one,3,9", "3,the,teh", "4,the,teh,substitution,1,3,9,10", "5,,teh,substitution,1,3,9", "6,null,nan,deletion,1,4,2"]
    good, rejected = files.read_dataset_csv_checked(spark, written(spark, "\n".join(lines), "csv"))
    assert sorted((r.id, r.correct_word, r.edit_distance) for r in good.collect()) == [(1, "the", 1), (6, "null", 1)]
    assert sorted((r.line, r.reason) for r in rejected.collect()) == [(lines[2], "number"), (lines[3], "columns"), (lines[4], "columns"), (lines[5], "missing")]
    assert {r.reason: r.lines for r in files.rejected_counts(rejected).collect()} == {"number": 1, "columns": 2, "missing": 1}


def test_first_articles_stop_early(spark):
    text = F.concat(F.repeat(F.lit("some words of an article that is long enough to count "), 5), F.col("id").cast("string"))
    pages = spark.range(0, 4_000, 1, 20).select(F.col("id").alias("doc_id"), F.lit("t").alias("title"), F.when(F.col("id") % 3 > 0, text).alias("text"))
    pages = stage(pages, "pages")
    read = Observation("read")
    observed = pages.observe(read, F.count(F.lit(1)).alias("n"))
    kept = corpus.first_articles(pages, 50)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(4_000) if i % 3][:50]
    # Ids reach the scan.
    plan = corpus.accepted_articles(pages.where(F.col("doc_id").between(0, 9)))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,0), LessThanOrEqual(doc_id,9)" in plan.replace("`", "")
    assert observed.count() == 4_000
    for most in (0, 1, 2_666, 2_667, 10_000):
        assert corpus.first_articles(pages, most).count() == min(most, len([i for i in range(4_000) if i % 3]))
    assert corpus.first_articles(pages.where("doc_id < 0"), 5).count() == 0


def test_result_files(spark, sf):
    preds = inputs.rule_predictions(spark, sf)
    path = fresh_path(spark, "results")
    results.write_results(path, preds)
    metrics, comparison, importance, seconds = results.read_results(spark, path)
    assert {r.model for r in metrics.collect()} == set(inputs.RULES)
    scores = [(r.place, r.val_f1) for r in comparison.orderBy("place").collect()]
    assert [p for p, _ in scores] == [1, 2, 3] and scores[0][1] >= scores[1][1] >= scores[2][1]
    assert importance.count() == 0 and seconds.count() == 0


def test_damaged_dump_of_the_tables(spark, sf):
    pages = files.read_wiki_pages(spark, inputs.damaged_dump(spark, sf))
    counts = {r.state: r["count"] for r in pages.groupBy("state").count().collect()}
    assert sum(counts.values()) == tables.wiki_pages(spark, sf).count() and counts["lost"] > 0 and counts["salvaged"] > 2 * counts["lost"] > 0
