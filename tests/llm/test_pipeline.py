"""The pipeline on a small fixture against a brute-force version of its stages."""

import hashlib
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import corpus_pipeline  # noqa: E402
from test_llm import SCHEMA, brute_print, brute_repeats  # noqa: E402
from terraline.llm import decontam, pipeline_stages  # noqa: E402

tiktoken = pytest.importorskip("tiktoken")
vocab = pytest.importorskip("public_tokenizers")


def test_pipeline(spark, tmp_path):
    rng = np.random.default_rng(20)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(words, n))
    passage, item = text(70), text(30)
    texts = [None, "", "123 !!", *(text(150) for _ in range(20))]
    texts += [texts[5], texts[6], f"{text(80)} {passage} {text(60)}", f"{text(50)} {passage} {text(90)}", f"{text(20)} {item} {text(20)}", text(1)]
    spark.createDataFrame([(i, t, "en" if i % 3 else "de", "s", len(t or "")) for i, t in enumerate(texts)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, f"file://{tmp_path}").collect()}

    left = {i: t for i, t in enumerate(texts) if t and any(map(str.isalpha, t))}
    first: dict = {}
    prints = {i: brute_print(t) for i, t in left.items()}
    for i in sorted(left):
        if not any((prints[i] ^ prints[j]).bit_count() <= 3 for j in first):
            first[i] = left[i]
    cut = {i: kept.decode("utf-8", "ignore") for i, (_, _, _, kept) in zip(first, brute_repeats(list(first.values()), 200), strict=True)}
    item_words = decontam.words_of(item.encode())
    grams = {tuple(item_words[k : k + 13]) for k in range(len(item_words) - 12)}
    clean = {}
    for i, t in cut.items():
        w = decontam.words_of(t.encode())
        hit = {p for k in range(len(w) - 12) if tuple(w[k : k + 13]) in grams for p in range(k, k + 13)}
        if not hit or 20 * len(hit) < len(w):
            clean[i] = t
    with open(vocab.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        from terraline.llm.bpe import load_ranks

        plain = tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=load_ranks(f.read()), special_tokens={})
    assert set(got) == set(clean) and len(clean) < len(first) < len(left)
    for i, t in clean.items():
        ids = plain.encode_ordinary(t)
        assert got[i]["n_tokens"] == len(ids) and got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert passage not in " ".join(cut.values())
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, f"file://{tmp_path}").columns == docs.columns, name
    nothing = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, f"file://{tmp_path}").count() == 0, name


def test_near_copies_beyond_three_bits(spark):
    rng = np.random.default_rng(31)
    words = [f"w{i}" for i in range(3000)]
    five = lambda t: {tuple(t[k : k + 5]) for k in range(len(t) - 4)}
    rows, copies, i = [], {}, 0
    while len(copies) < 60:
        a = rng.choice(words, 300).tolist()
        b = [w if rng.random() > 0.02 else "new" for w in a]
        x, y = five(a), five(b)
        if not 0.8 <= len(x & y) / len(x | y) < 0.9:
            continue
        rows += [(i, " ".join(a), "en", "s", 1), (i + 1, " ".join(b), "en", "s", 1)]
        copies[i + 1] = i
        i += 2
    far = rng.choice(words, 300).tolist()
    rows += [(i, " ".join(far), "en", "s", 1), (i + 1, " ".join(far[:200] + rng.choice(words, 100).tolist()), "en", "s", 1)]
    left = {r["doc_id"] for r in pipeline_stages.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert {*copies.values(), i, i + 1} <= left
    assert len(left & set(copies)) <= 0.1 * len(copies)
