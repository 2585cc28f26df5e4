"""Token counts, the conversation trie and whitening against plain versions, on hard rows too."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from listflow.llm import prefix_trie, queries, token_counts, whitening

VOCABULARY = queries.vocabulary("byte_bpe_50k.json")


# --- 11: token counts -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_the_librarys(library):
    draw = random.Random(3)
    parts = ["a", "b", "e", "the", " ", "  ", "\n", "\r\n", "\t", "'", "'s", "'ll", "1", "23", "!", "==", "é", "\U0001F600", "日本",
             "<|endoftext|>", "<|endo", "\x00", "Ᲊ", "՘", " ", "　", "\u0085", "\x1c", "ing", " and", "aaaa", "----",
             "̀", "ſ", "Ⅷ", "²", "٠", "\U000105c0"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(8000)]
    assert token_counts.Vocabulary(VOCABULARY).counts(texts).tolist() == library(texts)


def test_counts_of_long_pre_tokens_and_blocks(library, monkeypatch):
    draw = random.Random(4)
    texts = ["".join(draw.choice("abcdefghij") for _ in range(20000)), "x" * 7777, " " * 30001, "ab" * 5000 + "a", "word  " * 4000,
             "-----\n\n " * 3000, "<|endoftext|>" * 50, "é" * 3001, "x" * 70 + " " + "x" * 70]
    monkeypatch.setattr(token_counts, "BLOCK_CHARS", 1000)
    monkeypatch.setattr(token_counts, "MOST_KNOWN", 20)
    own = token_counts.Vocabulary(VOCABULARY)
    assert own.counts(texts).tolist() == library(texts)
    assert own.counts(texts[::-1]).tolist() == library(texts[::-1])


def test_symbols_left_follow_the_merges(library):
    """Every merge rule by hand: the lowest rank in a sequence first, from the left."""
    own = token_counts.Vocabulary(VOCABULARY)
    rank = {int(k): int(r) for k, r in zip(own.keys[:-1], own.ranks)}
    made = {int(k): int(m) for k, m in zip(own.keys, own.made)}
    words = [b"antidisestablishment", b" the", b"", b"aaaaaaa", b"\xff\xfe", b"banana bandana"]

    def plain(word):
        ids = [int(own.of_byte[b]) for b in word]
        while True:
            pairs = [(rank[a << 32 | b], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a << 32 | b in rank]
            if not pairs:
                return len(ids)
            i = min(pairs)[1]
            ids[i:i + 2] = [made[ids[i] << 32 | ids[i + 1]]]

    assert own.symbols_left(words).tolist() == [plain(w) for w in words]


def test_count_tokens_on_hard_rows(spark, library):
    texts = [None, "", "a b", "a b", "é " * 3000, "x" * 50000, "<|endoftext|>", "\n \n"]
    rows = [(i if i else None, t, 9, "o") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, over_limit string")
    out = token_counts.count_tokens(df, VOCABULARY, limit=2)
    assert out.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"]
    n = library([t or "" for t in texts])
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(
        repr((r[0], r[1], len((r[1] or "").encode()), k, k > 2)) for r, k in zip(rows, n))
    assert token_counts.count_tokens(df.filter("false"), VOCABULARY).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        token_counts.Vocabulary(queries.vocabulary("word_bpe_49k.json"))


def test_query_counts_every_document(spark, sf_dir, library):
    docs = {r[0]: r[1] or "" for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    found = queries.op11_token_counts(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in found} == {
        d: (len(t.encode()), n, n > 1024) for (d, t), n in zip(docs.items(), library(list(docs.values())))}


# --- 12: conversation trie --------------------------------------------------------------------

def plain_trie(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c in own:
        base, h = c - int(math.fmod(c, 5)), zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = collections.defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    children, leaves, saved = collections.Counter(p[:-1] for p in members if p), collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted((
        m[0], len(p), members[p[:-1]][0] if p else -10**9, len(m), children[p], leaves[p], saved[p],
        hashlib.sha256(",".join(str(c) for c in m if len(built[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


def found_trie(spark, rows, **options):
    df = spark.createDataFrame([(*r, 5, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, depth int, n_convs string")
    out = prefix_trie.conversation_trie(df, **options).collect()
    return sorted((r.conv_id, r.depth, -10**9 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in out)


def test_trie_on_hard_rows(spark):
    draw = random.Random(5)
    rows = [(c, t, draw.choice(["user", "bot", None]), draw.choice(["a", "é", "bb", None, ""]))
            for c in range(-12, 40) for t in range(draw.randint(0, 6))]
    rows += [(None, 1, "a", "b"), (3, None, None, None), (3, 2, "u", "x"), (3, 2, "u", "x"), (4, 0, "u", "long " * 50000)]
    draw.shuffle(rows)
    want = plain_trie(rows)
    assert found_trie(spark, rows) == want
    # the same in many shards, where every node may lie across borders
    assert found_trie(spark, rows, shard_turns=16) == want


def test_trie_of_copies_longer_than_a_matrix(spark):
    rows = [(500 + i, t, "u", "same") for i in range(30) for t in range(2 * prefix_trie.WIDTH + 9)]
    rows += [(600 + i, t, "u", "same" if t < prefix_trie.WIDTH + 5 else f"x{i % 4}") for i in range(10) for t in range(90)]
    assert found_trie(spark, rows, shard_turns=400) == plain_trie(rows)


def test_trie_of_none_and_one(spark, monkeypatch):
    assert found_trie(spark, []) == []
    for c in (5, 7):  # 7 keeps nothing of its own
        assert found_trie(spark, [(c, 0, "u", "t")]) == plain_trie([(c, 0, "u", "t")])
    # members' ids in many pieces
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 2)
    rows = [(i, 0, "u", "t") for i in range(25)]
    assert found_trie(spark, rows, shard_turns=20) == plain_trie(rows)


@pytest.mark.parametrize("seed", range(20))
def test_shared_lengths(seed):
    draw = np.random.default_rng(seed)
    seqs = [tuple(draw.integers(0, 2, draw.integers(0, 80) if draw.random() < .2 else draw.integers(0, 5)).tolist()) for _ in range(60)]
    seqs += [seqs[0][:40] + (1,) * k for k in range(3)]
    conv = draw.permutation(len(seqs)).astype(np.int64)
    flat = np.array([(0, t) for s in seqs for t in s], np.uint64).reshape(-1, 2)
    order, shared = prefix_trie.sorted_prefixes(flat, np.append(0, np.cumsum([len(s) for s in seqs])).astype(np.int64), conv)
    plain = sorted(range(len(seqs)), key=lambda i: (seqs[i], conv[i]))
    assert order.tolist() == plain

    def common(a, b):
        return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    assert shared.tolist() == [-1] + [common(seqs[a], seqs[b]) for a, b in zip(plain, plain[1:])]


# --- 13: whitening ----------------------------------------------------------------------------

def plain_whitening(rows):
    good = [(k, [float(np.float32(c)) for c in v]) for k, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max([len(v) for _, v in good], default=0)
    rows = [(k, tuple([math.floor(256 * c) for c in v] + [0] * (width - len(v)))) for k, v in good]
    if not width:
        return {}
    fit = sorted({x for _, x in rows})
    n, sums = len(fit), [sum(col) for col in zip(*fit)]
    centred = np.array(fit, float) - np.array(sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    out = collections.defaultdict(list)
    for k, x in rows:
        for c in range(min(4, width)):
            if values[c] > 1e-9 * values[0] > 0:
                y = (np.array(x, float) - np.array(sums) / n) @ axes[:, c] / math.sqrt(values[c])
                out[k, c + 1].append((n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), values[c] / values.sum(), abs(y)))
    return out


def check_whitening(spark, rows, any_axes=False):
    df = spark.createDataFrame([(k, v, 1, 2.0) for k, v in rows], "vec_id long, embedding array<float>, n int, x double")
    found, want = collections.defaultdict(list), plain_whitening(rows)
    got = whitening.whiten(df).collect()
    for r in got:
        found[r.vec_id, r.component].append((r.n, r.deviation, r.explained, abs(r.whitened)))
        assert r.identity_error < 1e-9
    assert set(found) == set(want)
    for k in want:
        a, b = sorted(found[k], key=str), sorted(want[k], key=str)
        assert [x[:2] for x in a] == [x[:2] for x in b]
        assert np.allclose([x[2] for x in a], [x[2] for x in b], rtol=1e-9)
        assert any_axes or np.allclose(sorted(x[3] for x in a), sorted(x[3] for x in b), atol=1e-8)
    signs = {c: {np.sign(r.whitened) for r in got if r.component == c} for c in range(1, 5)}
    assert all(len(s) <= 3 for s in signs.values())
    return got


def test_whitening_on_hard_rows(spark):
    draw = np.random.default_rng(1)
    rows = [(i, [float(z) for z in draw.standard_normal(7) * np.arange(1, 8)]) for i in range(80)]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (3, rows[3][1]), (90, None), (91, [1.0, None]), (92, [float("nan")] * 7),
             (93, [float("inf")] * 7), (94, [0.0] * 7), (95, [1.0, -0.0])]
    check_whitening(spark, rows)


def test_whitening_of_low_rank_and_equal_values(spark):
    draw = np.random.default_rng(2)
    base = np.round(draw.standard_normal((2, 9)) * 4)
    flat = check_whitening(spark, [(i, [float(z) for z in draw.integers(-5, 5, 2) @ base]) for i in range(60)])
    assert {r.component for r in flat} == {1, 2}
    cross = [(2 * i + j, [s if d == i else 0.0 for d in range(6)]) for i in range(6) for j, s in enumerate((1.0, -1.0))]
    assert {r.component for r in check_whitening(spark, cross, any_axes=True)} == {1, 2, 3, 4}
    for rows in ([], [(1, None)], [(1, [])], [(i, [1.0, 2.0]) for i in range(3)]):
        assert check_whitening(spark, rows) == []


def test_whitening_in_two_levels_of_sums(spark, monkeypatch):
    draw = np.random.default_rng(3)
    rows = [(i, [float(z) for z in draw.standard_normal(5)]) for i in range(200)]
    monkeypatch.setattr(whitening, "MOST_PARTS", 2)
    check_whitening(spark, rows)


def test_deviations_are_exact():
    block = np.array([[3 * 10**8, 1], [2**40, 2**41]], np.int64)
    exact = [sum((7 * x - s) ** 2 for x, s in zip(row, [5, 2**30])) for row in block.tolist()]
    assert whitening.deviations(block, 7, [5, 2**30]).to_pylist() == [exact[0] if exact[0] < 2**63 else None, None]


def test_query_whitens_every_embedding(spark, sf_dir):
    rows = [(r[0], r[1]) for r in queries.table(spark, sf_dir, "embeddings").select("vec_id", "embedding").collect()]
    want = plain_whitening(rows)
    for r in queries.op13_embedding_whitening(spark, sf_dir).collect():
        n, deviation, explained, y = want[r.vec_id, r.component][0]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.explained / explained - 1) < 1e-9 and abs(abs(r.whitened) - y) < 1e-8 and r.identity_error < 1e-9
