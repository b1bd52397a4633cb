"""The pipeline against plain Python, and stages on odd tables."""

import collections
import hashlib
import os

import corpus_pipeline
from tokenizers import Tokenizer

from volspark.llm import bpe, langid, mixing
from volspark.sinks import shared_folder

from .test_mixing import words
from .test_simhash import brute_components, brute_fingerprint


def test_stages_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = langid.fit(docs)
    labels = langid.label([r.text for r in rows.values()], model, False)
    kept = {i for i, (name, score, _) in zip(rows, labels) if name != "und" and score >= 0.4}
    largest = {}
    for i in kept:
        largest[rows[i].text] = max(i, largest.get(rows[i].text, i))
    kept = set(largest.values())
    prints = {i: brute_fingerprint(rows[i].text) for i in kept}
    near = brute_components(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i in sorted(kept, reverse=True):
        least[near[prints[i]]] = i
    kept = set(least.values())
    left = docs.filter(docs.doc_id.isin(list(kept)))
    copies = {r.doc_id: r.copies for r in mixing.mix(left).collect()}
    assert set(copies) == kept
    library = Tokenizer.from_file(bpe.default_vocabulary())
    wanted = collections.Counter()
    for i, n in copies.items():
        ids = library.encode(rows[i].text, add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        wanted[i, len(ids), digest, hashlib.sha256(rows[i].text.encode()).hexdigest()] += int(n)
    before = set(os.listdir(shared_folder(spark)))
    out = corpus_pipeline.run(spark, folder)
    assert len(set(os.listdir(shared_folder(spark))) - before) == 1
    got = collections.Counter(
        map(tuple, out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    )
    assert got == +wanted
    assert sum(words(rows[i].text) for i, *_ in got) > 0


def test_stages_keep_the_columns(spark, edge_docs, no_docs):
    assert len(corpus_pipeline.STAGES) == 5
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, "").columns == docs.columns
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, "").collect()


def test_one_row_of_each_where_ids_repeat(spark):
    texts = ["a b c d e f", "quite another text of seven words here", "and one more of them now"]
    rows = [(1, texts[0], "x"), (5, texts[0], "x"), (5, texts[0], "x"), (5, texts[0], "y")]
    rows += [(None, texts[1], "x"), (None, texts[1], "y"), (7, texts[2], "x"), (8, "", "x"), (8, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = corpus_pipeline.exact_dedup(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in out) == sorted(
        [(0, texts[1]), (5, texts[0]), (7, texts[2]), (8, "")]
    )
    # near copies: the same words in other cases
    rows += [(5, texts[0].upper(), "x"), (1, texts[0].upper(), "x"), (1, texts[0], "x")]
    rows += [(None, texts[1].upper(), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").filter("text != ''")
    out = corpus_pipeline.simhash_dedup(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text.lower()) for r in out) == sorted(
        [(0, texts[1]), (1, texts[0]), (7, texts[2])]
    )
