"""The training-data operators against brute force, and the cases that their docstrings define."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from terraline.llm import bpe, chat, components, decontam, fmindex, langid, sadedup, sais, sharding, simhash, telephony, tokencount, tokenfile

tokenizers = pytest.importorskip("tokenizers")
tiktoken = pytest.importorskip("tiktoken")
vocab = pytest.importorskip("public_tokenizers")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "The cat sat on the mat and looked at a dog. " * 3000
TEXTS = [
    None, "", "   \n\t ", "a", "one two", "one two", "The quick brown fox jumps over the lazy dog near the old river bank today",
    "Größe Straße über Bär", "日本語 テキスト です", "1234 !!! ...", "x" * 5000, LONG, "Ünïcödé " * 40, "\x1c\x85  odd blanks",
]


def docs_of(spark, texts, extra=True):
    rows = [(i, t, "en" if i % 2 else "de", "s", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(1) for c in ("n_tokens", "ids", "score", "shard", "slot", "n_bytes", "kept", "items", "row", "fp")}) if extra else df


def sha(b):
    return hashlib.sha256(b).hexdigest()


# ------------------------------------------------------------------------------------------------ suffix arrays


@pytest.mark.parametrize("sigma", [1, 2, 3, 40, 250, 256])
def test_suffix_array_and_lcp(sigma):
    rng = np.random.default_rng(sigma)
    for n in (0, 1, 2, 64, 65, 700, 3000):
        t = rng.integers(0, sigma, n).astype(np.uint8)
        for t in (t, np.tile(t[: n // 7 + 1], 8)[:n], np.sort(t)):
            b, sa = bytes(t), sais.suffix_array(t)
            assert list(sa) == sorted(range(n), key=lambda i, b=b: b[i:])
            most = np.minimum(np.arange(n, 0, -1), 30)
            got = sais.permuted_lcp(t, sa, most)
            for i, j in zip(sa[1:].tolist(), sa[:-1].tolist(), strict=True):
                k = 0
                while k < min(most[i], most[j]) and b[i + k] == b[j + k]:
                    k += 1
                assert got[i] == k


def test_wide_alphabets():
    rng = np.random.default_rng(5)
    t = np.tile(rng.integers(0, 10**6, 400), 3)
    assert list(sais.doubling(t)) == list(sais.suffix_array(t)) == sorted(range(len(t)), key=lambda i: list(t[i:]))
    for sigma in (2, 3, 300, 5000):
        for n in (2, 65, 200, 3000):
            t = rng.integers(0, sigma, n)
            for t in (t, np.tile(t[: n // 7 + 1], 8)[:n], np.sort(t), np.sort(t)[::-1].copy(), np.repeat(t[: n // 5 + 1], 5)[:n]):
                assert list(sais.suffix_array(t)) == list(sais._wide(t)) == list(sais.doubling(t))


def test_fm_index():
    rng = np.random.default_rng(1)
    t = rng.integers(0, 6, 2000)
    index = fmindex.FMIndex(t, 6, sample=8)
    patterns = np.array([t[i : i + 4] for i in range(0, 400, 7)] + [[5, 5, 5, 5]])
    sizes = np.array([1 + i % 4 for i in range(len(patterns))])
    low, high = index.search(patterns.reshape(-1), 4 * np.arange(len(patterns)), sizes)
    for p, s, a, b in zip(patterns, sizes, low, high, strict=True):
        want = [i for i in range(len(t) - s + 1) if (t[i : i + s] == p[:s]).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


# ------------------------------------------------------------------------------------------------ op 1


def test_automaton_is_greedy_parsing():
    data = b"abracadabra banana"
    model = langid.Model([("a", 1, data), ("b", 1, b"xyz" * 20)])
    for text in (b"abra", b"banana abracad", b"zzz", b"abx" * 400):
        n = i = 0
        while i < len(text):
            k = 1
            while i + k < len(text) and text[i : i + k + 1] in data:
                k += 1
            if text[i : i + 1] not in data:
                k = 1
            n, i = n + 1, i + k
        got = model.phrases([text])[0, 0]
        assert abs(got - n) <= 1 + text.count(b"x") + text.count(b"z")  # an unknown symbol ends a phrase of its own


@pytest.mark.parametrize("block", [1, 3, 64, 512])
def test_phrases_cross_blocks(monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    rng = np.random.default_rng(5)
    draw = lambda n: bytes(rng.choice(list(b"ab n"), n).tolist())
    samples = [draw(400), b"aaab nab" * 9, b"abn " * 40]
    model = langid.Model([(str(k), 1, x) for k, x in enumerate(samples)])
    texts = [b"", b"a", b"a" * 3000, b"ab" * 1500 + b"n", b"nab " * 256, *(draw(n) for n in (1, 511, 512, 513, 1025, 2600))]  # parses of runs never meet
    assert model.phrases(texts).tolist() == [[brute_phrases(text, x) for text in texts] for x in samples]


def brute_phrases(text, sample):
    """Greedy phrases of a whole text by substring search."""
    n = i = 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i:j] in sample and text[i : j + 1] in sample:
            j += 1
        # a symbol that the sample lacks ends the phrase before it, and the one that it begins
        n, i = n + 1, j
    return n


def test_predictions_against_brute_force(spark):
    rng = np.random.default_rng(3)
    words = {lang: ["".join(rng.choice(list(letters), rng.integers(2, 8))) for _ in range(150)] for lang, letters in (("a", "abcde"), ("b", "cdefg"), ("c", "abefgh"))}
    rows = [(i, " ".join(rng.choice(words["abc"[i % 3]], 30)), "abc"[i % 3], "s", 0) for i in range(240)]
    rows += [(300 + i, " ".join(rng.choice(words["abc"[i % 3]], n)), None, "s", 0) for i, n in enumerate([1, 2, 400, 90, 5, 700])] + [(400, "zzz yyy", None, "s", 0), (None, rows[0][1], None, "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("score", "lang_pred", "bits", "__x")})
    samples = langid.learn(docs.where(~langid.held_out() & F.col("doc_id").isNotNull()))
    order = sorted(samples, key=lambda x: (-x[1], x[0]))
    got = {r["doc_id"]: r for r in langid.language_id(docs).collect()}
    for i, text, *_ in rows:
        data = langid.normalise(text)
        bits = [brute_phrases(data, x[2]) * math.log2(len(x[2])) / len(data) for x in order]
        best = min(range(3), key=bits.__getitem__)
        share = 1 / sum(2 ** (min(len(data), 32) * (bits[best] - b)) for b in bits)
        assert (got[i]["lang_pred"], got[i]["bits"], got[i]["score"]) == (order[best][0], pytest.approx(bits[best]), pytest.approx(share)), i


def test_language_id_cases(spark):
    en, de = "the and of in that is was for with from this have", "der die und das ist nicht mit von auch sich eine werden"
    rng = np.random.default_rng(2)
    pick = lambda s: " ".join(rng.choice(s.split(), 40))
    rows = [(i, pick(en if i % 2 else de), "en" if i % 2 else "de", "s", 0) for i in range(200)] + [(500 + i, t, None, "s", 0) for i, t in enumerate(TEXTS)]
    got = {r["doc_id"]: r for r in langid.language_id(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (i in held) for i in range(200))
    assert np.mean([got[i]["lang_pred"] == ("en" if i % 2 else "de") for i in held]) >= 0.95
    for i, t in enumerate(TEXTS):
        assert (got[500 + i]["lang_pred"] == "und") == (not t or not any(map(str.isalpha, t)))
        assert 0 <= got[500 + i]["score"] <= 1
    empty = langid.language_id(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0
    nothing = langid.language_id(spark.createDataFrame([(1, "abc", None, "s", 3)], SCHEMA)).first()
    assert nothing["lang_pred"] == "und"


# ------------------------------------------------------------------------------------------------ op 2


def test_chat_collapse(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (3, 2, "user", "more"),
        (4, 0, "user", "hi"), (4, 1, "assistant", "yo"), (4, 2, "user", "other <|im_end|>"), (5, 0, "user", "hi"), (5, 1, "assistant", "yo"), (5, 2, "user", "more"),
        (6, 0, None, None), (6, 0, None, None), (None, 0, "user", "alone"), (7, 1, "user", "b"), (7, 1, "user", "a"),
    ]
    schema = "conv_id long, turn int, role string, text string"
    got = {r["conv_id"]: r for r in chat.collapse_and_render(spark.createDataFrame(rows, schema).withColumn("n_turns", F.lit(0))).collect()}
    assert set(got) == {3, 4, 6, None, 7}
    assert got[3]["rendered"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n<|im_start|>user\nmore<|im_end|>" and got[3]["n_turns"] == 3
    assert "other <| im_end|><|im_end|>" in got[4]["rendered"]
    assert got[6]["rendered"] == "<|im_start|>\n<|im_end|>" and got[7]["n_turns"] == 2
    assert chat.collapse_and_render(spark.createDataFrame([], schema)).count() == 0


def test_native_plans(spark):
    docs = docs_of(spark, TEXTS, extra=False).select("doc_id", F.lit(0).cast("long").alias("size"), F.lit(0).cast("long").alias("text_crc32"))
    turns = spark.createDataFrame([(1, 0, "u", "x")], "conv_id long, turn int, role string, text string")
    for df in (sharding.shard_rows(docs, ["doc_id"]), chat.collapse_and_render(turns)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


# ------------------------------------------------------------------------------------------------ op 3


def brute_path(word, scores):
    """Tokens and pieces of the best path, by all splits of every prefix."""
    low = min(scores.values(), default=0.0) - 10
    best = [(0.0, 0, [])]
    for j in range(1, len(word) + 1):
        found = [(best[i][0] + scores[word[i:j]], -best[i][1] - 1, i, best[i][2] + [word[i:j]]) for i in range(j - 1, -1, -1) if word[i:j] in scores]
        if word[j - 1] not in scores:
            found.append((best[j - 1][0] + low, -best[j - 1][1] - len(word[j - 1].encode()), j - 1, best[j - 1][2]))
        s, n, _, path = max(found, key=lambda x: x[:3])
        best.append((s, -n, path))
    return best[-1][1:]


def test_token_counts(spark):
    pieces = tokencount.load_pieces(vocab.path("piece_bpe_32k.model"))
    texts = [*TEXTS[:10], "internationalization of tokenizers is unbelievably good", "x" * 300, "日本語" * 60, "a" * 95 + " " + "b" * 96 + " " + "the" * 32, *TEXTS[11:]]
    docs = docs_of(spark, texts)
    words = Counter(w.decode() for t in texts for w in (t or "").encode().split())
    scores = dict.fromkeys(pieces, -np.log(len(pieces)))
    for _ in range(tokencount.ROUNDS):
        used = Counter()
        for w, n in words.items():
            for p in brute_path(tokencount.MARK + w, scores)[1]:
                used[p] += n
        total = sum(used.values()) + tokencount.SMOOTH * len(pieces)
        scores = {p: np.log(used[p] + tokencount.SMOOTH) - np.log(total) for p in pieces}
    learned = tokencount.estimate(docs, pieces)
    assert list(learned) == pieces and np.allclose(list(learned.values()), list(scores.values()))
    got = {r["doc_id"]: (r["n_pretokens"], r["n_tokens"]) for r in tokencount.count_tokens(docs, learned).collect()}
    for i, t in enumerate(texts):
        each = [w.decode() for w in (t or "").encode().split()]
        assert got[i] == (len(each), sum(brute_path(tokencount.MARK + w, learned)[0] for w in set(each) for _ in range(each.count(w))))
    nothing = docs_of(spark, [])
    assert tokencount.count_tokens(nothing, tokencount.estimate(nothing, pieces)).count() == 0
    assert tokencount.estimate(docs, []) == {}


def test_token_counts_equal_a_unigram_model(spark, tmp_path):
    import sentencepiece

    rng = np.random.default_rng(9)
    parts = ["re", "inter", "nation", "al", "iz", "ation", "un", "believ", "able", "ly", "token", "s", "ing"]
    lines = [" ".join("".join(rng.choice(parts, rng.integers(1, 5))) for _ in range(12)) for _ in range(400)]
    with open(tmp_path / "lines.txt", "w") as f:
        f.write("\n".join(lines))
    sentencepiece.SentencePieceTrainer.train(input=str(tmp_path / "lines.txt"), model_prefix=str(tmp_path / "m"), vocab_size=120, model_type="unigram", hard_vocab_limit=False, minloglevel=2)
    model = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "m.model"))
    scores = {p: model.get_score(model.piece_to_id(p)) for p in tokencount.load_pieces(str(tmp_path / "m.model"))}
    texts = [*lines[:60], "international" * 12, " ".join(lines[:20])]
    got = {r["doc_id"]: r["n_tokens"] for r in tokencount.count_tokens(docs_of(spark, texts), scores).collect()}
    assert [got[i] for i in range(len(texts))] == [len(model.encode(t)) for t in texts]


def test_tries_forget_without_a_difference(monkeypatch):
    scores = {tokencount.MARK: -3.0, "a": -2.0, "b": -2.5, "ab": -3.0, tokencount.MARK + "a": -2.5, "bab": -4.0}
    texts = [b"ab abba a", b"babab aab", None, b"x" * 200 + b" ab", b"abab" * 60]
    trie = tokencount.UnigramTrie(scores)
    want = [x.tolist() for x in trie.count(texts)]
    monkeypatch.setattr(tokencount, "_KNOWN", 1)
    monkeypatch.setattr(tokencount, "_TRIE", 2)
    monkeypatch.setattr(tokencount, "DEEP", 5)
    small = tokencount.UnigramTrie(scores)
    assert [[int(small.count([t])[k][0]) for t in texts] for k in (0, 1)] == want


# ------------------------------------------------------------------------------------------------ op 4


def test_bpe_equals_tiktoken(spark):
    path = vocab.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = bpe.load_ranks(f.read())
    plain = tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(7)
    bits = ["a", "b", "aa", "the", " ", "  ", "\n", "ing", "é", "1", "!!", "日本", "'s", "꟎", "\U000323af"]
    texts = [*TEXTS, "a" * 20000, "ab" * 9000, *("".join(bits[k] for k in rng.integers(0, len(bits), 80)) for _ in range(300))]
    got = {r["doc_id"]: r for r in bpe.encode(docs_of(spark, texts), path, vocab.PATTERN).collect()}
    for i, t in enumerate(texts):
        want = plain.encode_ordinary(t or "")
        assert list(got[i]["ids"]) == want and got[i]["n_tokens"] == len(want) and bytes(got[i]["decoded"]) == (t or "").encode()
    assert bpe.tokenized(docs_of(spark, [])).count() == 0
    digest = bpe.tokenized(docs_of(spark, ["hello world"])).first()
    assert digest["ids_sha256"] == sha(np.array(plain.encode_ordinary("hello world"), "<u4").tobytes()) and digest["decoded_sha256"] == sha(b"hello world")
    with pytest.raises(ValueError):
        bpe.Encoder(ranks, vocab.PATTERN).decode(np.array([10**6]), np.array([0, 1]))


def test_every_token_replays_to_itself():
    with open(vocab.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = bpe.load_ranks(f.read())
    tokens = list(ranks)
    ids, start = bpe.Encoder(ranks, vocab.PATTERN).replay(tokens)
    assert (np.diff(start) == 1).all() and ids.tolist() == list(ranks.values())


# ------------------------------------------------------------------------------------------------ op 5


def brute_print(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [" ".join(rng.choice(["red", "blue", "green", "sky", "sea", "land", "tree", "stone"], 300)) for _ in range(6)]
    texts = [*TEXTS, *base, *[b + " extra" for b in base], *[b.replace("sky", "skies", 1) for b in base], base[0], base[0]]
    prints = [brute_print(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and find(i) != find(j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs_of(spark, texts)).collect()}
    for i in range(len(texts)):
        assert got[i]["fp"] % 2**64 == prints[i] and got[i]["component_id"] == find(i)
    left = {r["doc_id"] for r in simhash.first_of_each(docs_of(spark, texts)).collect()}
    assert left == {find(i) for i in range(len(texts))}
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_simhash_in_blocks(monkeypatch):
    texts = [t.encode() if t is not None else None for t in TEXTS]
    whole = simhash.fingerprints(texts)
    monkeypatch.setattr(simhash, "_BLOCK", 64)
    monkeypatch.setattr(simhash, "_ROWS", 50)
    assert (simhash.fingerprints(texts) == whole).all()


@pytest.mark.parametrize("n", [10, 10**4, 10**8, 10**11])
def test_thresholds_cover_all_pairs(n):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (500, 64))
    plan = simhash.allocate(n, (x.T @ x) * (n / 500), 3)
    assert sorted(b for bits, _ in plan for b in bits) == list(range(64)) and sum(t + 1 for _, t in plan) == 4
    for _ in range(200):
        flipped = set(rng.choice(64, 3, replace=False).tolist())
        assert any(len(flipped & set(bits)) <= t for bits, t in plan)


def test_links_are_complete_under_every_plan(spark):
    rng = np.random.default_rng(4)
    seed = [int(x) for x in rng.integers(0, 2**63, 8)]
    values = {int(np.uint64(s ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False))).astype(np.int64)) for s in seed for k in range(5) for _ in range(4)}
    prints = spark.createDataFrame([(v,) for v in values], "fp long")
    want = {(a, b) for a in values for b in values if a < b and ((a ^ b) % 2**64).bit_count() <= 3}
    halves, thirds = [list(range(32)), list(range(32, 64))], [list(range(22)), list(range(22, 43)), list(range(43, 64))]
    for plan in ([(halves[0], 1), (halves[1], 1)], [(halves[0], 2), (halves[1], 0)], [(thirds[0], 0), (thirds[1], 1), (thirds[2], 0)]):
        assert {(r["a"], r["b"]) for r in simhash.links(prints, plan, 3).collect()} == want


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    got, _ = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["v"]: r["root"] for r in got.collect()} == {**{i: 0 for i in range(1, 51)}, **{100 + i: 100 for i in range(1, 40)}}


# ------------------------------------------------------------------------------------------------ op 6


def test_sharding_law(spark):
    rows = [(i % 900, "x" * (i % 50), i % 3) for i in range(1003)] + [(None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = sharding.shard_rows(docs, ["doc_id", "text"], shards=7).toPandas()
    assert len(got) == 1004 and sorted(got.groupby("shard").size()) == [143] * 4 + [144] * 3
    for _, s in got.groupby("shard"):
        assert sorted(s["slot"]) == list(range(len(s)))
    again = sharding.shard_rows(docs.repartition(5), ["doc_id", "text"], shards=7).toPandas()
    key = lambda d: Counter(zip(d["doc_id"].fillna(-1), d["text"].fillna(""), d["shard"], d["slot"], strict=True))
    assert key(got) == key(again)
    assert sharding.shard_rows(docs.limit(0), ["doc_id"]).count() == 0
    assert sharding.shard_rows(docs.limit(3), ["doc_id"], shards=40).count() == 3


def test_sharding_columns(spark, tmp_path):
    texts = [*TEXTS, "x" * 200_000, "x" * 200_000]
    docs = [(None if i == 3 else i // 2, t, "en", "s", 0) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, SCHEMA).withColumns({"shard": F.lit(1), "law": F.lit("x")}).write.parquet(f"{tmp_path}/documents.parquet")
    got = sharding.op6_sharding(spark, f"file://{tmp_path}").collect()
    size = lambda t: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((d[0], *size(d[1])) for d in docs)
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}
    assert Counter(r["shard"] for r in got) == {s: 1 for s in range(len(texts))} and {r["slot"] for r in got} == {0}


def test_communication_matrix_is_exact_and_uniform():
    blocks, ranges = [50, 30, 20], [25, 25, 50]
    total = np.zeros((3, 3))
    for seed in range(400):
        m = np.array(sharding.communication_matrix(blocks, ranges, seed))
        assert m.sum(1).tolist() == blocks and m.sum(0).tolist() == ranges
        total += m
    assert np.allclose(total / 400, np.outer(blocks, ranges) / 100, atol=0.5)
    rng = np.random.default_rng(0)
    draws = [sharding.hypergeometric(rng, 3 * 10**9, 10**9, 10**6) for _ in range(50)]
    assert abs(np.mean(draws) - 750_000) < 400


# ------------------------------------------------------------------------------------------------ op 7


def test_token_files_round_trip(spark, tmp_path):
    with open(vocab.path("word_bpe_49k.json"), encoding="utf-8") as f:
        json = f.read()
    plain = tokenizers.Tokenizer.from_str(json)
    rng = np.random.default_rng(3)
    bits = ["a", "É", "é", "́", " ", " ", "\n", "don't", "'s", "İ", "ΑΣ", "ß", "日本", "1", "!!", "<|endoftext|>", "A,", "b.", ","]
    texts = [*TEXTS, *("".join(bits[k] for k in rng.integers(0, len(bits), 30)) for _ in range(300))]
    docs = docs_of(spark, texts).orderBy(F.desc("doc_id")).repartition(3)
    tokenfile.write(docs, json, f"file://{tmp_path}/t")
    got = {r["doc_id"]: r for r in tokenfile.read(spark, f"file://{tmp_path}/t").collect()}
    start = 0
    for i, t in enumerate(texts):
        want = [*plain.encode(t or "", add_special_tokens=False).ids, tokenfile.END_ID]
        assert (got[i]["start"], got[i]["n_tokens"], list(got[i]["ids"])) == (start, len(want), want)
        start += len(want)
    digest = {r["doc_id"]: r["ids_crc32"] for r in tokenfile.read(spark, f"file://{tmp_path}/t", "digest").collect()}
    assert digest[0] == zlib.crc32(np.array([2], "<u4").tobytes())
    tokenfile.write(docs_of(spark, []), json, f"file://{tmp_path}/empty")
    assert tokenfile.read(spark, f"file://{tmp_path}/empty").count() == 0


def test_token_files_of_repeated_ids(spark, tmp_path):
    """Null ids, one id of many rows and equal rows: spread over parts, in order, none lost."""
    with open(vocab.path("word_bpe_49k.json"), encoding="utf-8") as f:
        json = f.read()
    plain = tokenizers.Tokenizer.from_str(json)
    rows = [(None, f"null {i % 50}") for i in range(300)] + [(7, f"word {i}") for i in range(300)] + [(7, "the same") for _ in range(300)] + [(3, "first"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tokenfile.write(docs, json, f"file://{tmp_path}/t")
    got = sorted(tokenfile.read(spark, f"file://{tmp_path}/t").collect(), key=lambda r: r["start"])
    assert [(-1 if r["doc_id"] is None else r["doc_id"]) for r in got] == sorted(-1 if i is None else i for i, _ in rows)
    ends = [r["start"] + r["n_tokens"] for r in got]
    assert [r["start"] for r in got] == [0, *ends[:-1]] and all(r["n_tokens"] == len(r["ids"]) for r in got)
    want = sorted((-1 if i is None else i, [*plain.encode(t or "", add_special_tokens=False).ids, tokenfile.END_ID]) for i, t in rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], list(r["ids"])) for r in got) == want
    counts = {r["part"]: r["n"] for r in spark.read.parquet(f"file://{tmp_path}/t/blocks").selectExpr("part", "size(doc_ids) as n").groupBy("part").sum("n").toDF("part", "n").collect()}
    assert len(counts) > 1 and max(counts.values()) < 600  # the hot id is in several parts


@pytest.mark.parametrize("most", [6, 8, 16])
def test_huffman_lengths(most):
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987, 1597, 2584, 4181, 6765])
    lengths = tokenfile.code_lengths(counts, most)
    assert lengths.max() <= most and np.sum(2.0**-lengths) == 1 and (np.diff(lengths) <= 0).all()
    if most == 16:
        import heapq

        heap, free = [(int(c), i, [i]) for i, c in enumerate(counts)], np.zeros(len(counts), int)
        heapq.heapify(heap)
        k = len(counts)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            free[a[2] + b[2]] += 1
            heapq.heappush(heap, (a[0] + b[0], k := k + 1, a[2] + b[2]))
        assert free.max() > 16 or (counts * lengths).sum() == (counts * free).sum()
    code = tokenfile.Code(np.arange(len(counts)) * 3, lengths)
    ids = np.random.default_rng(0).integers(0, len(counts), 5000) * 3
    data, marks = code.pack(ids)
    steps = np.minimum(tokenfile.STEP, len(ids) - tokenfile.STEP * np.arange(len(marks)))
    assert (code.unpack(data, marks, steps) == ids).all()


# ------------------------------------------------------------------------------------------------ op 8


def test_decontamination_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(12)] + ["über", "x9"]
    items = [(i, " ".join(rng.choice(words, n))) for i, n in enumerate([5, 13, 14, 30, 40, 1, 20, 20])] + [(100, None), (101, " .,! "), (None, "w1 w2 w3"), (102, items_text := "W1, w2; W3 (w4)")]
    texts = [*TEXTS, *(" ".join(rng.choice(words, 60)) for _ in range(30)), *(f"pre {t} post" for _, t in items if t), "w1 w2 w3 w4 " * 10]
    assert items_text
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows: dict = {}
    for i, t in items:
        w = find(t)
        if i is not None and w:
            for k in range(max(1, len(w) - 12)):
                windows.setdefault(tuple(w[k : k + 13]), set()).add(str(i))
    for size, whole in ((decontam.BLOCK_BYTES, decontam.PASS_BYTES), (60, 1000), (200, 400)):  # one block, several, several passes
        monkeypatch.setattr(decontam, "BLOCK_BYTES", size)
        monkeypatch.setattr(decontam, "PASS_BYTES", whole)
        monkeypatch.setattr(decontam, "_PAIRS", size)
        got = {r["doc_id"]: r for r in decontam.decontaminate(docs_of(spark, texts), benchmark).collect()}
        for i, t in enumerate(texts):
            w, hit, found = find(t), set(), set()
            for n in {len(x) for x in windows}:
                for k in range(len(w) - n + 1):
                    if tuple(w[k : k + n]) in windows:
                        hit.update(range(k, k + n))
                        found |= windows[tuple(w[k : k + n])]
            r = got[i]
            assert (r["n_words"], r["n_hit"], r["items"]) == (len(w), len(hit), sorted(found))
            assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(w))
            assert {k for a, b in r["spans"] for k in range(a, b)} == hit
    assert decontam.decontaminate(docs_of(spark, []), benchmark).count() == 0
    none = decontam.decontaminate(docs_of(spark, TEXTS), benchmark.limit(0))
    assert none.where("n_hit > 0").count() == 0
    clean = decontam.clean_documents(docs_of(spark, texts), benchmark)
    assert clean.columns == docs_of(spark, texts).columns and {r["doc_id"] for r in clean.collect()} == {i for i, r in got.items() if not r["contaminated"]}


# ------------------------------------------------------------------------------------------------ op 9


def slow_mulaw(byte):
    u = 255 - byte
    size = (((u % 16) * 8 + 132) * 2 ** (u // 16 % 8)) - 132
    return -size if u >= 128 else size


def slow_ima(block):
    value, index = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
    out = [value]
    for byte in block[4:]:
        for nib in (byte & 15, byte >> 4):
            step = int(telephony.IMA_STEPS[index])
            d = step >> 3
            d += step if nib & 4 else 0
            d += step >> 1 if nib & 2 else 0
            d += step >> 2 if nib & 1 else 0
            value = max(-32768, min(32767, value - d if nib & 8 else value + d))
            index = max(0, min(88, index + int(telephony.IMA_INDEX[nib])))
            out.append(value)
    return out


def test_telephony(spark):
    got = {r["doc_id"]: r for r in telephony.media_columns(docs_of(spark, TEXTS)).collect()}
    for i, t in enumerate(TEXTS):
        b = (t or "").encode()
        p = b + b"\0" * (-len(b) % 64 or (0 if b else 64))
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(b), len(p), sha(p), zlib.crc32(p[-64:]))
        assert telephony.from_wave(bytes(r["media"])) == (7, 8000, p) and r["media_sha256"] == sha(bytes(r["media"])) and len(r["pcm"]) == 4 * len(p)
        pcm = [slow_mulaw(x) for x in p]
        ima = sum((slow_ima(p[k : k + 64]) for k in range(0, len(p), 64)), []) if len(p) < 20_000 else None
        wide = np.array([y for a, b in zip(pcm, [*pcm[1:], pcm[-1]], strict=True) for y in (a, (a + b) // 2)], "<i2").tobytes()
        rms = lambda v: math.isqrt(sum(x * x for x in v) // len(v))
        f = dict(x.split("=") for x in r["feature"].split(";"))
        assert bytes(r["pcm"]) == wide and f["pcm_crc32"] == f"{zlib.crc32(wide):08x}" and int(f["mulaw_rms"]) == rms(pcm)
        assert int(f["alaw_rms"]) == rms([int(telephony.TABLES[telephony.ALAW][x]) for x in p]) and (ima is None or int(f["ima_rms"]) == rms(ima))
        assert int(f["crossings"]) == sum((a < 0) != (b < 0) for a, b in zip(pcm, pcm[1:], strict=False))
    assert got[4]["feature"] == got[5]["feature"]
    assert telephony.media_columns(docs_of(spark, [])).count() == 0
    with pytest.raises(ValueError):
        telephony.from_wave(b"nonsense")


def test_codecs():
    mu, a = telephony.TABLES[telephony.MULAW], telephony.TABLES[telephony.ALAW]
    assert (mu[0], mu[0x80], mu[0xFF], mu[0x7F]) == (-32124, 32124, 0, 0) and (a[0xD5], a[0x55], a[0xAA], a[0x2A]) == (8, -8, 32256, -32256)

    blocks = np.random.default_rng(0).integers(0, 256, (20, 64)).astype(np.uint8)
    assert telephony.decode_ima(blocks).tolist() == [slow_ima(bytes(b)) for b in blocks]
    assert telephony.resample(np.array([0, 10, 20], np.int16), 8000, 16000).tolist() == [0, 5, 10, 15, 20, 20]
    assert telephony.resample(np.arange(8, dtype=np.int16), 16000, 8000).tolist() == [0, 2, 4, 6]


# ------------------------------------------------------------------------------------------------ op 10


def brute_repeats(texts, n):
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + n] for b in data for i in range(len(b) - n + 1))
    out = []
    for b in data:
        cover = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if count[b[i : i + n]] > 1:
                cover[i : i + n] = True
        edges = int((np.diff(np.r_[False, cover].astype(int)) == 1).sum())
        out.append((len(b), int(cover.sum()), edges, bytes(np.frombuffer(b, np.uint8)[~cover])))
    return out


@pytest.mark.parametrize("hot", [sadedup.HOT, 1])
def test_suffix_array_dedup_against_brute_force(spark, hot):
    rng = np.random.default_rng(10)
    word = lambda n: "".join(rng.choice(list("abcdé "), n))
    shared = [word(n) for n in (150, 200, 205, 260, 400)]
    texts = [*[t if t is None or len(t) < 9000 else t[:9000] for t in TEXTS], *[word(80) + s + word(90) for s in shared for _ in range(3)], "ab" * 300, "abc" * 100 + word(50) + "abc" * 90, word(500), word(500)]
    texts += [texts[-1], shared[3][:230] + word(100), word(30) + shared[4][100:330]]
    got = {r["doc_id"]: r for r in sadedup.remove_repeats(docs_of(spark, texts), hot=hot).collect()}
    for i, want in enumerate(brute_repeats(texts, 200)):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want, i
    assert sadedup.remove_repeats(docs_of(spark, [])).count() == 0


def test_copies_of_a_row_cost_linear_entries(spark):
    rng = np.random.default_rng(13)
    text = "".join(rng.choice(list("abcdef "), 3000))
    sizes = []
    for n in (20, 80):
        got = sadedup.repeated_ranges(spark.createDataFrame([(1, text)] * n + [(2, text[:900] + "x" * 50)], "doc_id long, text string")).collect()
        sizes.append(sorted(len(r["ranges"]) for r in got))
    assert sizes[0] == sizes[1] and sizes[0][-1] < 100


def test_anchors_do_not_depend_on_the_batch(monkeypatch):
    rng = np.random.default_rng(14)
    texts = [bytes(rng.integers(97, 101, 700).astype(np.uint8)) for _ in range(40)]
    monkeypatch.setattr(sadedup.Roller, "grams", lambda self, flat, k: np.convolve(flat, np.arange(1, k + 1), "valid").astype(np.uint64) % 7 << np.uint64(40))  # many ties
    together = sadedup.anchors(texts, 200, 32)
    for i, t in enumerate(texts):
        alone = sadedup.anchors([t], 200, 32)
        for a, b in zip(alone[1:], together[1:], strict=True):
            assert (a == b[together[0] == i]).all()


def test_short_strings_and_shards(spark, monkeypatch):
    rng = np.random.default_rng(11)
    texts = ["".join(rng.choice(list("abcd"), 300)) for _ in range(12)]
    texts += [texts[0][40:90] + texts[1][10:60] + texts[2][100:140]] * 2
    monkeypatch.setattr(sadedup, "_SHARD", 500)
    got = {r["doc_id"]: r for r in sadedup.remove_repeats(docs_of(spark, texts), length=20).collect()}
    for i, want in enumerate(brute_repeats(texts, 20)):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], bytes(got[i]["kept"])) == want, i


def test_repeated_ids_and_rows(spark):
    rng = np.random.default_rng(12)
    a, b = ("".join(rng.choice(list("abcdef "), 400)) for _ in range(2))
    rows = [(1, a), (1, a), (1, b), (None, a[:250]), (None, None)]
    got = sorted((r["n_bytes"], r["n_removed"]) for r in sadedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, 0), (250, 250), (400, 0), (400, 400), (400, 400)]
    cut = sadedup.without_repeats(spark.createDataFrame([(1, a, "en", "s", 400), (2, a + b, "en", "s", 800), (3, None, "en", "s", 0)], SCHEMA)).toPandas().set_index("doc_id")
    assert cut.loc[1, "text"] == "" and cut.loc[2, "text"] == b and cut.loc[2, "n_chars"] == 400 and pd.isna(cut.loc[3, "text"])
