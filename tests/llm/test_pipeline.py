"""Every stage of the pipeline against a plain version of its own input."""

import re
import zlib

import corpus_pipeline
import numpy as np
from public_tokenizers import path
from test_mixing import brute
from test_pairs import brute_components, brute_fingerprint, brute_lines
from tokenizers import Tokenizer

from wordloom.llm import toxicity
from wordloom.staging import stage


def test_stages(spark, sf):
    docs = corpus_pipeline.documents(spark, sf)
    columns, given = docs.columns, docs.collect()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_dedup", "mixing", "bpe"]

    def step(name, docs):
        out = stage(stages[name](spark, docs, sf), name)
        if name != "bpe":
            assert out.columns == columns
        return out, sorted(out.collect(), key=lambda r: r.doc_id)

    out, clean = step("toxicity", docs)
    model = toxicity.fit_on_training_rows(spark, docs, sf)
    assert 0 < len(clean) < len(given)
    for r in given:
        tokens = re.findall(r"[^\W\d_]+", r.text.lower())
        found = toxicity.text_segments(model.token_score, tokens)
        assert (model.probability(toxicity.evidence(model, found, len(tokens))) < 0.5) == (r.doc_id in {c.doc_id for c in clean})

    out, lined = step("line_dedup", out)
    want = {i: t for i, _, _, t in brute_lines([(r.doc_id, r.text) for r in clean])}
    assert {r.doc_id: r.text for r in lined} == want and all(r.n_chars == len(r.text) for r in lined)

    out, single = step("near_dedup", out)
    groups = brute_components({r.doc_id: brute_fingerprint(r.text) for r in lined})
    assert [r.doc_id for r in single] == sorted(set(groups.values()))

    out, mixed = step("mixing", out)
    rows = [(r.doc_id, "d%d" % (zlib.crc32(r.source.encode()) % 3), r.lang, r.source, len(r.text.split())) for r in single]
    chosen = brute(rows, corpus_pipeline.MIX_PERCENT, corpus_pipeline.MIX_WEIGHTS, 1, 42)
    assert sorted(r.doc_id for r in mixed) == [i for i, _, _ in chosen]

    _, coded = step("bpe", out)
    library, texts = Tokenizer.from_file(path("word_bpe_49k.json")), {r.doc_id: r.text for r in mixed}
    for r in coded:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.token_ids), "<u4").tolist() == ids and r.decoded == library.decode(ids, skip_special_tokens=False)


def test_run_equals_stages(spark, sf):
    rows = corpus_pipeline.run(spark, sf)
    assert rows.columns == ["doc_id", "lang", "source", "n_tokens", "token_ids", "decoded"]
    assert 0 < rows.count() < corpus_pipeline.documents(spark, sf).count()


def test_stages_on_odd_rows(spark, odd, empty, sf):
    """Nulls, empty and long texts, repeated rows, a clashing extra column and an empty table go through all stages."""
    columns = ["doc_id", "text", "lang", "source", "n_chars", "score"]
    for docs in (odd, empty):
        docs = docs.selectExpr("*", "length(text) AS n_chars", "0.5D AS score").select(*columns)
        for name, run in corpus_pipeline.STAGES:
            out = run(spark, docs, sf)
            # Each stage gives the columns that it was given, but for its own last word on the score.
            docs = stage(out.select(*[c for c in columns if c in out.columns]) if name != "bpe" else out, name)
        ids = {r.doc_id for r in docs.collect()}
        assert ids <= {r.doc_id for r in odd.collect()} and (ids or docs.count() == 0)
