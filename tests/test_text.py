import functools

from pyspark.sql import functions as F

from wordloom.functions import text as tx
from wordloom.operators import corpus


def one(spark, make, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(make(*[F.col(c) for c in df.columns]).alias("v")).first().v


def test_lazy_piped_link_swallows_text(spark):
    assert one(spark, tx.unwrap_piped_links, "[[a]] text [[b|c]]") == "c"


def test_nested_template_leaves_residue(spark):
    assert one(spark, tx.drop_templates, "x{{a{{b}}c}}y") == "xc}}y"


def test_template_spans_lines_but_heading_does_not(spark):
    assert one(spark, tx.drop_templates, "x{{a\nb}}y") == "xy"
    assert one(spark, tx.drop_headings, "== a\nb ==") == "== a\nb =="


def test_dot_excludes_line_feed_only(spark):
    assert one(spark, tx.unwrap_plain_links, "[[a\rb]]") == "a\rb"


def test_words_are_ascii_letter_runs_bounded_by_non_word_characters(spark):
    assert one(spark, tx.english_words, "résumé abc a1 x foo_bar Don't İx") == ["abc", "don"]


def test_sentence_tokens(spark):
    assert one(spark, tx.sentence_tokens, "Don't go, été!") == ["Don", "'", "t", "go", ",", "été", "!"]
    keep = lambda c: tx.sentence_tokens(c, preserve_apostrophe=True)
    assert one(spark, keep, "Don't go") == ["Don't", "go"]


def test_clean_null_is_empty(spark):
    assert one(spark, tx.clean_text, None) == ""


ODD_TEXTS = [
    None, "", " ", "plain words, no markup; it's  fine - really!", "a{{b}}c {{d\ne}} {x}", "[{{x}}[a|b]] [[c]] [[d", "= =={{=}} ==\n== h == t",
    "<b>x</b> a < b", "see http://x.y/z?q now", "htt{{x}}p://joined end", "tab\tnbsp\u00a0thin\u2009line\u2028x\u0085y\x1cz\x00w", "\u00a0 # lead and trail @ \u3000",
    "a*/b \U0001F600 c\u0301d \u200b e", "été Ünï 數字 ٣ _x_ $5", "{{" * 50 + "==" * 50, "1 | 2 | 3\r\n\r\n4", "x" + "# " * 100 + "y",
]


def test_cleaning_in_fewer_passes_gives_what_the_single_steps_give(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_TEXTS)], "id int, text string")
    chain = functools.reduce(lambda t, step: step(t), tx.CLEANING_STEPS, F.col("text"))
    for r in rows.select("text", chain.alias("want"), tx.clean_text(F.col("text")).alias("got")).collect():
        assert r.got == r.want, r.text


def test_texts_without_markup_pass_one_pattern(spark):
    rows = spark.range(1).select(F.col("id").cast("string").alias("text"))
    plan = rows.select(tx.clean_text(F.col("text")).alias("out"))._jdf.queryExecution().optimizedPlan().toString()
    always = plan[: plan.index("CASE WHEN")] + plan[plan.index(" ELSE ") :]
    assert always.count("regexp_replace(") == 1 and plan.count("regexp_replace(") == 7


def test_unicode_blanks_collapse(spark):
    assert one(spark, tx.collapse_space, "  a \tb\x1c") == "a b"


def test_rejoin(spark):
    rejoined = lambda c: tx.rejoin(tx.sentence_tokens(c))
    assert one(spark, rejoined, "a b, c! (d)") == "a b, c! ( d )"


def test_article_cap_counts_accepted_articles(spark):
    good = "word " * 30
    rows = [(1, "t", good), (2, "File:x", good), (3, "t", "short"), (4, "t", good), (5, "t", good), (6, "", good)]
    pages = spark.createDataFrame(rows, "doc_id long, title string, text string")
    assert sorted(r.doc_id for r in corpus.accepted_articles(pages, 2).collect()) == [1, 4]
    assert corpus.count_accepted(pages).first().articles == 3
