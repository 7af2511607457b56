"""The pipeline against brute-force versions of its stages."""

import struct

import corpus_pipeline
import public_tokenizers
import tiktoken
from llm_common import SF_MED
from test_llm_dedup import brute_components, brute_fp, brute_hits
from test_llm_filters import brute_stats, check_surrogates

from pricewise.llm import bpe, quality_rules


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_MED}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    kept = sorted(r.doc_id for r in quality_rules.judge(docs).collect() if r.kept)
    assert not any(brute_stats(text[i])[5] for i in kept)
    fps = {i: brute_fp(text[i]) for i in kept}
    comp, first = brute_components(fps.values()), {}
    for i in kept:
        first.setdefault(comp[fps[i]], i)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_MED}/benchmark.parquet").collect()]
    want = {h[0] for h in brute_hits([(i, text[i]) for i in first.values()], items) if not h[5]}
    assert 0 < len(want) < len(first) < len(kept)

    rows = corpus_pipeline.run(spark, SF_MED).collect()
    assert sorted(r.doc_id for r in rows) == sorted(want)
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(f.read()),
                                   special_tokens={})
    for r in rows:
        ids = list(struct.unpack(f"<{r.n_tokens}I", r.ids))
        assert ids == public.encode_ordinary(r.text) and public.decode(ids) == r.text
    assert check_surrogates([text[r.doc_id] for r in rows], [r.text for r in rows]) > 10


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_MED}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    empty = docs.filter("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, SF_MED)
        assert out.columns == docs.columns and out.count() == 0
