"""Training-data operators on hard rows: nulls, empty and long texts, ties, repeated rows, clashing names."""

import collections
import html
import random
import re
import textwrap
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from listflow.llm import (
    boosting, extraction, licences, line_rules, media, mixing, packing, quality, queries, quotations, similar, toxicity)
from listflow.llm.textbytes import flat, prefix_ends, word_hashes, words
from listflow.session import cut_lineage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, score double, row string, taken long, "
           "_words long, kept boolean, h string, n int, _row long, _group long, words string")
LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(60000))


def hard_rows():
    prose = "the quick brown fox jumps over the lazy dog and runs far away from all of the hounds today"
    texts = [None, "", " \n\t ", "one", "a b c", prose, prose, prose + " again", "x " * 500, LONG, LONG + " tail",
             "é ü \U0001F600 ñ", "| a | b | c |", "THIS IS LOUD!!", "a\x00b c", "<|endoftext|> is text here"]
    rows = []
    for i, t in enumerate(texts):
        rows.append((i, t, "en", [None, "a", "b", "a"][i % 4], len(t or ""), 9.0, "r", 5, 6, True, "h", 1, 2, 3, "w"))
    rows += [rows[5], rows[5], (None, prose, None, None, None, None, None, None, None, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None, None, None, None, None, None, None, None), rows[0]]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(hard_rows(), COLUMNS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(16)] + [(None, 1, 1), (3, None, None), (4, 1, 0)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


def word_list(text):
    return WORD.findall(text or "")


# --- words and hashes -------------------------------------------------------------------------

@given(st.lists(st.text(alphabet="ab é\n\t\x0b\U0001F600", max_size=12) | st.none(), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_of_many_texts(texts):
    data, offsets = flat(pa.array(texts, pa.string()))
    starts, ends, at = words(data, offsets)
    raw = data.tobytes()
    found = [[raw[a:b].decode() for a, b in zip(starts[x:y], ends[x:y])] for x, y in zip(at, at[1:])]
    assert found == [word_list(t) for t in texts]
    hashes = word_hashes(data, starts, ends)
    by_word = collections.defaultdict(set)
    for w, h in zip([w for ws in found for w in ws], hashes.tolist()):
        by_word[w].add(h)
    assert all(len(v) == 1 for v in by_word.values())
    assert len({min(v) for v in by_word.values()}) == len(by_word)
    cut = prefix_ends(data, starts, ends, 2)
    assert [raw[a:b].decode() for a, b in zip(starts, cut)] == [w[:2] if len(w) >= 2 else "" for ws in found for w in ws]


# --- 1: extraction ----------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body><header><p>Site of many things and wonders</p></header><nav><ul><li><a href=/a>Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site for everything that we do, all of the time.</div>
<article><h1>Title &amp; more</h1><p>First   paragraph<br>goes <b>o</b>n.<p>Second&nbsp;one.<form><input><p>mail</p></form>
<aside>Aside text</aside><p>Last.</article><div id="comments"><p>A reader says a lot of things here, at length and often.</p></div>
<footer>&copy; foot</footer></body></html>"""


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("just text", "just text"), ("a < b & c", "a < b & c"),
    (PAGE, "Title & more\nFirst paragraph goes on.\nSecond one.\nLast."),
    (PAGE.replace("article>", "div>"), "Title & more\nFirst paragraph goes on.\nSecond one.\nLast."),
    ("<article><p>x<!-- <p>y</p> --><script>z", "x"), ("<article><p>tail<di", "tail"),
    ("<article><p>&lt;p&gt; &#x41;&#0;", "<p> A�")])
def test_main_text(page, text):
    assert extraction.main_text(page) == text


@pytest.mark.parametrize("wrapper", [
    '<div class="content-sidebar-wrap">', '<div class="layout has-sidebar">', '<div class="elementor-widget-wrap">',
    '<div id="post" class="post no-comments">', '<form id="aspnetForm">', '<div class="widget"><div class="ad"><form>'])
def test_wrappers_named_like_furniture(wrapper):
    inner = PAGE[PAGE.index("<header>"):].replace("<form><input><p>mail</p></form>", "")  # forms don't nest
    for page in (inner, inner.replace("article>", "div>"), inner[inner.index("<article>"):inner.index("<div id=")]):
        assert extraction.main_text(f"<body>{wrapper}{page}") == "Title & more\nFirst paragraph goes on.\nSecond one.\nLast."


@pytest.mark.parametrize("page, text", [
    ("<nav><p>All that there is</p></nav>", "All that there is"),
    ("<div class=ad><p>All that there is</p></div><footer>foot</footer>", "All that there is"),
    ("<p><a>Top</a></p><article><h1><a>Title</a></h1><p><a>First</a></p><p>a</p><p>b</p><ul><li><a>x</a><li><a>y</a><li><a>z</a><li><a>w</a></ul>"
     "<p>c</p><p><a>Last</a></article>", "Title\nFirst\na\nb\nx\ny\nz\nw\nc\nLast"),
    ("<article><p>Short post.</p></article><div id=comments><article>" + "<p>A reader says a lot.</p>" * 9 + "</article></div>", "Short post.")])
def test_no_text_is_lost(page, text):
    assert extraction.main_text(page) == text


def test_pages_of_the_table(spark, sf_dir):
    rows = queries.op1_html_extraction(spark, sf_dir).join(queries.table(spark, sf_dir, "pages").select("page_id", "html"), "page_id").collect()
    for row in rows:
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", row.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert row.text == "\n".join(b for b in blocks if b)
        assert row.n_chars == len(row.text)


def plain_surges(lines, window, surge):
    """The lines between surge and dive points as the definition puts it, sums taken anew for each line."""
    lengths = [0 if f else n for n, f in lines]
    sums = [sum(lengths[i:i + window]) for i in range(len(lines))]
    kept, runs, inside = [], [], None
    for i, (n, f) in enumerate(lines):
        if inside is None and lengths[i]:
            inside = [i]
        elif inside is not None and sums[i] and not f:
            inside.append(i)
        elif inside is not None:
            runs.append(inside)
            inside = None
    runs += [inside] if inside else []
    for run in runs:
        last = max(i for i in run if lengths[i])
        if any(sums[i] > surge for i in run):
            kept += range(run[0], last + 1)
    if not kept and runs:
        best = max(runs, key=lambda r: sum(lengths[i] for i in r))
        kept = list(range(best[0], max(i for i in best if lengths[i]) + 1))
    return kept


@given(st.lists(st.tuples(st.integers(1, 60), st.sampled_from(["p", "p", "p", "linked", "linked", "linked", "nav"])), max_size=25))
@settings(max_examples=300, deadline=None)
def test_surge_and_dive_points(blocks):
    page = "".join({"p": f"<p>{i:03d}{'x' * n}</p>", "linked": f"<p><a>{i:03d}{'x' * n}</a></p>", "nav": f"<nav>{i:03d}{'x' * n}</nav>"}[kind]
                   for i, (n, kind) in enumerate(blocks))
    # furniture stands between two empty lines
    lines = [(i, n + 3 if kind == "p" else 0, kind == "nav") for i, (n, kind) in enumerate(blocks) for _ in range(3 if kind == "nav" else 1)]
    if any(n for _, n, _ in lines):
        kept = [lines[k][0] for k in plain_surges([x[1:] for x in lines], 3, 80)]
        assert [int(t[:3]) for t in extraction.main_text(page).split("\n")] == kept
    for mark in ("article", "main"):
        marked = extraction.main_text(f"<p>Before it a long line stands that would surge on its own, if nothing said where the text is.</p><{mark}>{page}</{mark}>")
        if any(kind == "p" for _, kind in blocks):
            assert [int(t[:3]) for t in marked.split("\n")] == [i for i, (_, kind) in enumerate(blocks) if kind != "nav"]


def test_comment_blocks_of_other_names():
    for name in ("user-responses", "reader-feedback", "comment-thread"):
        page = f"<div><p>{'A story is told here. ' * 9}</p></div><div class={name}><p>{'A reader says a lot. ' * 5}</p></div>"
        assert extraction.main_text(page) == ("A story is told here. " * 9).strip()


def test_hostile_markup_is_linear():
    for piece in ("<p>", "<a '", "<div class=\"", "<!--", "<b><i>", "&amp;", "<"):
        extraction.main_text(piece * 20000)


def test_extraction_keeps_rows_and_replaces_columns(spark):
    pages = spark.createDataFrame([(1, "<p>a", "old", 3), (1, "<p>a", "old", 3), (None, None, None, None)],
                                  "page_id long, html string, text string, n_chars int")
    got = sorted(map(str, extraction.extract_main_text(pages).select("page_id", "text", "n_chars").collect()))
    assert got == sorted(["Row(page_id=1, text='a', n_chars=1)"] * 2 + ["Row(page_id=None, text='', n_chars=0)"])
    assert extraction.extract_main_text(pages.filter("false")).count() == 0


# --- 2: media ---------------------------------------------------------------------------------

@given(st.binary(max_size=400), st.integers(0, 3))
@settings(max_examples=80, deadline=None)
def test_lzw_round_trip(data, times):
    data = data * (8 ** times)
    assert media.lzw_decode(media.lzw_encode(data), 8, len(data)) == data


@pytest.mark.parametrize("least", range(2, 9))
def test_lzw_of_every_width(least):
    rng = random.Random(least)
    data = bytes(rng.randrange(1 << least) for _ in range(30000))
    assert media.lzw_decode(media.lzw_encode(data, least), least, len(data)) == data


def plain_lzw(codes_of, least, samples):
    """A decoder that reads bit by bit."""
    out, table, width, at, last = b"", None, least + 1, 0, None
    bits = "".join(f"{b:08b}"[::-1] for b in codes_of)
    while at + width <= len(bits) and len(out) < samples:
        code = int(bits[at:at + width][::-1], 2)
        at += width
        if code == 1 << least:
            table, width, last = [bytes([i]) for i in range(1 << least)] + [b"", b""], least + 1, None
            continue
        if code == (1 << least) + 1:
            break
        entry = table[code] if code < len(table) else last + last[:1]
        out += entry
        if last is not None and len(table) < 4096:
            table.append(last + entry[:1])
        if len(table) == 1 << width and width < 12:
            width += 1
        last = entry
    return out[:samples]


def test_lzw_agrees_with_a_plain_decoder():
    data = ("the thing of the others " * 400 + "".join(chr(32 + i * i % 90) for i in range(9000))).encode()
    assert plain_lzw(media.lzw_encode(data), 8, len(data)) == data


def gif(frames, size=(2, 2), palette=b"\0\0\0\xff\0\0\0\xff\0\0\0\xff"):
    import struct

    out = b"GIF89a" + struct.pack("<HHBBB", *size, 0x81, 0, 0) + palette
    for (left, top, w, h), index, disposal, transparent, local in frames:
        out += struct.pack("<BBBBHBB", 0x21, 0xF9, 4, disposal << 2 | (transparent is not None), 7, transparent or 0, 0)
        out += struct.pack("<BHHHHB", 0x2C, left, top, w, h, 0x81 if local else 0) + (local or b"")
        stream = media.lzw_encode(bytes(index), 2)
        out += b"\x02" + bytes([len(stream)]) + stream + b"\0"
    return out + b"\x21\xfe\x02hi\0;"


def test_frames_disposal_transparency_and_palettes():
    r, g, b, k, w = (255, 0, 0), (0, 255, 0), (0, 0, 255), (0, 0, 0), (255, 255, 255)
    raw = gif([((0, 0, 2, 2), [1, 2, 3, 0], 1, None, None),        # kept
               ((0, 0, 1, 1), [3], 3, None, None),                 # then what was before
               ((1, 0, 1, 2), [0, 2], 2, 0, None),                 # transparent above, then cleared
               ((0, 0, 1, 1), [1], 0, None, b"\0\0\0\xff\xff\xff" + b"\0" * 6)])
    canvas = [[tuple(map(int, p)) for p in f.canvas.reshape(-1, 3)] for f in media.read_gif(raw)]
    assert canvas == [[r, g, b, k], [b, g, b, k], [r, g, b, g], [w, k, b, k]]
    assert [(f.start_ms, f.delay_ms) for f in media.read_gif(raw)] == [(0, 70), (70, 70), (140, 70), (210, 70)]


def test_interlaced_rows():
    rows = np.arange(11)[:, None]
    sent = np.concatenate([rows[0::8], rows[4::8], rows[2::4], rows[1::2]])
    assert (media._interlaced(sent) == rows).all()


def test_damaged_files_have_what_was_before():
    raw = media.write_gif(b"a" * media.UNIT)
    square = ((0, 0, 2, 2), [1, 2, 3, 0], 1, None, b"\0\0\0\xff\xff\xff" + b"\0" * 6)
    for whole in (raw, gif([square] * 2)):
        frames = [len(list(media.read_gif(whole[:cut]))) for cut in range(len(whole) + 1)]
        assert frames[0] == 0 and frames == sorted(frames) and frames[-1] == len(list(media.read_gif(whole))) > 0


def test_sizes_beyond_the_file_are_refused():
    assert list(media.read_gif(b"GIF89a\xff\xff\xff\xff\0\0\0;")) == []
    assert list(media.read_gif(gif([((1, 0, 2, 2), [1, 2, 3, 0], 1, None, None)]))) == []
    assert list(media.read_gif(b"no gif at all, really")) == []


def test_media_digest_of_hard_rows(docs, empty):
    got = media.media_digest(media.store_texts(docs.select("doc_id", "text", "n"))).collect()
    assert len(got) == docs.count()
    by_text = {}
    for row in media.media_digest(media.store_texts(docs.select(F.col("text").alias("k"), "text"))).collect():
        raw = (row.k or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        assert (row.n_bytes, row.payload_bytes) == (len(raw), len(payload))
        assert row.tail_crc32 == zlib.crc32(payload[-32:])
        assert by_text.setdefault(raw, row.feature) == row.feature
    assert media.media_digest(media.store_texts(empty)).count() == 0


def test_frames_table(docs):
    frames = media.media_frames(media.store_texts(docs.select("doc_id", "text").filter("doc_id = 9")), "doc_id").orderBy("frame").collect()
    payload = b"".join(bytes(f.samples) for f in frames)
    assert payload[:len(LONG)] == LONG.encode() and set(payload[len(LONG):]) <= {255}
    assert all(sum(f.histogram) == 24 * max(x.height for x in frames) for f in frames)
    assert [f.start_ms for f in frames] == [100 * k for k in range(len(frames))]


# --- 3: mixing --------------------------------------------------------------------------------

def plain_targets(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        level = rest / sum(w[s] for s in open_) if open_ else 0
        more = {s for s in open_ if level * w[s] > 2 * sizes[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in full else level * w[s] for s in order}
        full |= more


def test_mix_of_hard_rows(docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken, ties = collections.Counter(), collections.Counter(), collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        ties[r.source, r.place] += 1
        assert 0 <= r.taken <= 2 * r.size
    targets = plain_targets(dict(sizes))
    for r in rows:
        assert r.target == pytest.approx(targets[r.source]) and r.source_size == sizes[r.source]
    for s in sizes:
        assert 0 <= targets[s] - taken[s] <= 1 + max(n for (a, _), n in ties.items() if a == s)
    assert mixing.mix(empty).count() == 0
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, rows))


def plain_difference(rows, mixed):
    """Words of each source in the applied mix less those that the mix takes, and its longest text."""
    difference, longest = collections.Counter(), collections.Counter()
    for r in rows:
        difference[r.source] += len(word_list(r.text))
    for r in mixed:
        difference[r.source] -= r.taken
        longest[r.source] = max(longest[r.source], r.size)
    return difference, longest


def test_applied_mix_takes_whole_documents(docs):
    applied, mixed = mixing.apply_mix(docs), mixing.mix(docs).collect()
    assert applied.columns == docs.columns
    rows = applied.collect()
    given = collections.Counter(map(str, docs.collect()))
    assert all(n <= 2 * given[r] for r, n in collections.Counter(map(str, rows)).items())
    difference, longest = plain_difference(rows, mixed)
    assert all(2 * abs(n) <= longest[s] for s, n in difference.items())


@pytest.mark.parametrize("key", [None, 7])
def test_texts_of_equal_ids_are_taken_whole(spark, key):
    texts = [" ".join(f"t{i}w{k}" for k in range(5 + i % 7)) for i in range(40)] + ["five words of one copy"] * 9
    docs = spark.createDataFrame([(key, s, t) for s in ("a", None) for t in texts], "doc_id long, source string, text string")
    rows = mixing.apply_mix(docs).collect()
    assert {r.text for r in rows} == set(texts) and len(rows) > len(texts) * 2
    difference, longest = plain_difference(rows, mixing.mix(docs).collect())
    assert all(2 * abs(n) <= longest[s] for s, n in difference.items())


# --- 4 and 5: classifiers ---------------------------------------------------------------------

def test_forest_matches_a_plain_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 4)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = boosting.fit(x, y, trees=20, depth=3)

    def walk(row):
        total = forest.base
        for f, t, v in zip(forest.feature, forest.threshold, forest.value):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            total += v[node - len(f)]
        return total

    assert forest.margins(x[:50]) == pytest.approx([walk(r) for r in x[:50]])
    assert ((forest.scores(x) > 0.5) == y).mean() > 0.95


def test_isotonic_is_the_best_monotone_fit():
    rng = np.random.default_rng(2)
    score, y = rng.normal(size=300), rng.integers(0, 2, 300)
    knots, rates = boosting.isotonic(score, y)
    assert (np.diff(rates) >= 0).all() and (np.diff(knots) > 0).all()
    assert rates[0] >= 0 and rates[-1] <= 1
    s = np.array([1.0, 2, 3, 4])
    assert boosting.isotonic(s, np.array([0, 1, 0, 1]))[1].tolist() == [0.0, 0.5, 1.0]


@pytest.mark.parametrize("y", [[], [1.0], [1.0] * 30, [0.0] * 30])
def test_degenerate_labels(y):
    x = np.zeros((len(y), 3), np.float32)
    score = boosting.fit(x, np.array(y)).scores(np.zeros((2, 3), np.float32))
    assert ((score > 0) & (score < 1)).all()


def test_features_do_not_depend_on_the_batch(docs):
    texts = [r[1] for r in hard_rows()]
    for features in (quality.document_statistics, lambda d, o: toxicity.toxic_features(toxicity.Learnt(["fox", "jum*"]), d, o)):
        together = features(*flat(pa.array(texts, pa.string())))
        alone = np.concatenate([features(*flat(pa.array([t], pa.string()))) for t in texts])
        assert np.allclose(together, alone) and np.isfinite(together).all()
    assert len(quality.FEATURES) == quality.document_statistics(*flat(pa.array(["a"]))).shape[1]
    assert len(toxicity.FEATURES) == toxicity.toxic_features(toxicity.Learnt(), *flat(pa.array(["a"]))).shape[1]


def test_hidden_and_near_lexicon_words():
    def of(text, name):
        return toxicity.toxic_features(toxicity.Learnt(), *flat(pa.array([text])))[0][toxicity.FEATURES.index(name)]

    assert of("you are an idiot", "insult_count") > 0 and of("you are an idiot", "near_count") > 0
    for hidden in ("an 1d1ot here", "an i.d.i.o.t here", "an idiooot here"):
        assert of(hidden, "insult_hidden") > 0 == of(hidden, "insult_count"), hidden
    assert of("idiot " + "word " * 9 + "you", "near_count") == 0


def test_classifiers_on_hard_rows(docs, empty, labels):
    for fit, score in ((quality.fit_quality, quality.score_quality), (toxicity.fit_toxicity, toxicity.score_toxicity)):
        model = fit(docs, labels)
        rows = score(docs, model).select("doc_id", "score").collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert score(empty, model).count() == 0
        score(docs, fit(empty, labels)).count()
        score(docs, fit(docs, labels.filter("false"))).count()


def test_held_out_rows(spark, labels):
    sample = quality.labelled_sample(labels, "quality", quality.remainder(F.col("doc_id"), 5) != 0).collect()
    assert {r._key for r in sample} == {i for i in range(16) if zlib.crc32(str(i).encode()) % 5}
    assert len(quality.labelled_sample(labels, "quality", F.lit(True), most=4).collect()) == 4


@pytest.mark.parametrize("query, label, by, held", [("op4_quality_classifier", "quality", 5, 0), ("op5_toxicity", "toxic", 3, 1)])
def test_held_out_accuracy(spark, query, label, by, held):
    big = "/root/testdata/sf0.1"
    rows = queries.QUERIES[query](spark, big).join(queries.table(spark, big, "labels"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % by == held) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r[label] for r in unseen]) > (0.99 if by == 5 else 0.98)


# --- 6: quotations ----------------------------------------------------------------------------

CHATS = [
    (1, 0, "user", "Hello there\nhow are you"), (1, 1, "assistant", "> Hello there\nI am fine"),
    (1, 2, "user", "Bob wrote:\n>> hello   THERE\n> I am fine\ngood"), (1, 3, "user", "alone"),
    (1, 4, "user", "> nothing known"), (1, 5, "user", "> good\n>\n> I am fine\nboth"), (1, 5, "user", "> good\n>\n> I am fine\nboth"),
    (1, 6, "user", "> both\nagain"), (2, 0, "u", None), (2, None, "u", "x"), (None, 1, "u", "> y"), (2, 1, "u", "> Hello there"), (2, 2, "u", "")]


@pytest.fixture(scope="module")
def chats(spark):
    return spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string").withColumns(
        {"root": F.lit("r"), "depth": F.lit("old"), "row": F.lit(1), "level": F.lit(2), "conv": F.lit(3)})


def test_threads(chats):
    got = {(r.conv_id, r.turn): (r.own_text, r.n_quoted, r.n_linked, r.max_level, r.reply_to, r.thread_turn, r.depth)
           for r in quotations.thread_messages(chats).collect()}
    assert got[1, 0] == ("Hello there\nhow are you", 0, 0, 0, None, 0, 0)
    assert got[1, 1] == ("I am fine", 1, 1, 1, 0, 0, 1)
    assert got[1, 2] == ("good", 2, 2, 2, 1, 0, 2)
    assert got[1, 4] == ("", 1, 0, 1, None, 4, 0)
    assert got[1, 5] == ("both", 2, 2, 1, 2, 0, 3)
    assert got[1, 6] == ("again", 1, 1, 1, 5, 0, 4)
    assert got[2, 1][4] is None and got[None, 1][1] == 0 and got[2, None][0] == "x"
    assert quotations.thread_messages(chats).count() == len(CHATS)
    assert quotations.thread_messages(chats.filter("false")).count() == 0
    assert quotations.thread_messages(chats).columns == [
        "conv_id", "turn", "role", "text", "root", "row", "level", "conv", "own_text", "n_quoted", "max_level", "n_linked",
        "reply_to", "thread_turn", "depth"]


LONG_TURN = ("I would like to ask about the tram that runs along the river, because it was late again on Monday. "
             "Nobody at the stop knew why. The board showed nothing at all for twenty minutes, and then two came at once.")


@pytest.mark.parametrize("quote, reply_to, linked", [
    (textwrap.fill(LONG_TURN, 72, initial_indent="> ", subsequent_indent="> "), 1, 3),
    (textwrap.fill(LONG_TURN, 30, initial_indent="> ", subsequent_indent="> "), 1, 8),
    ("> Nobody at the stop knew why.", 1, 1), ("> board showed nothing at all", 1, 1), ("> Why not?", 2, 1),
    ("> nobody knew of any tram at the river stop today", None, 0)])
def test_wrapped_and_partial_quotes(spark, quote, reply_to, linked):
    rows = [(1, 0, "Good morning."), (1, 1, LONG_TURN), (1, 2, "They never say. Why not? Ask them."), (1, 3, f"Anna wrote:\n{quote}\nSo it was.")]
    got = quotations.thread_messages(spark.createDataFrame(rows, "conv_id long, turn long, text string")).filter("turn = 3").first()
    assert (got.reply_to, got.n_linked, got.own_text) == (reply_to, linked, "So it was.")
    assert got.thread_turn == (3 if reply_to is None else reply_to) and got.n_quoted >= linked


def test_quotation_oracle_on_quotes(spark, chats, tmp_path):
    path = str(tmp_path / "chats")
    chats.select("conv_id", "turn", "role", "text").coalesce(1).write.parquet(f"{path}/conversations.parquet")
    got = queries.op6_quotation_threads(spark, path).toPandas()
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{path}/conversations.parquet/*.parquet'")
    want = con.execute(queries.ORACLES["op6_quotation_threads"]).df()

    def plain(frame):
        return sorted(str([None if v != v or v is None else int(v) if isinstance(v, float) else v for v in row])
                      for row in frame[list(got.columns)].astype(object).values.tolist())

    assert plain(got) == plain(want.astype(object).where(want.notna(), None))


def test_native_operators_have_no_python(chats, docs):
    for frame in (quotations.thread_messages(chats), licences.scan_licences(docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# --- 7: line rules ----------------------------------------------------------------------------

@given(st.lists(st.sampled_from("abc"), max_size=40))
@settings(max_examples=200, deadline=None)
def test_repeated_words(some):
    runs = [tuple(some[i:i + 5]) for i in range(len(some) - 4)]
    count = collections.Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if count[r] > 1 for k in range(5)}
    assert line_rules.repeated_words(some) == len(covered)


@pytest.mark.parametrize("line, fails", [
    ("Home | News | Sport", True), ("A long sentence with a bar | in it and more words after it.", False),
    ("short and open", True), ("Short.", False), ("All rights reserved.", True), ("a# b$ c* d%", True),
    ("THIS IS VERY LOUD", True), ("no no no no no no no no no no.", True), ("Plain words make up this line without any end", False)])
def test_line_rules(line, fails):
    assert line_rules.line_fails(line, word_list(line)) == fails


@pytest.mark.parametrize("line, fails", [
    ("The design in this house is older than the street.", False), ("It is a dialog in two acts for three voices.", False),
    ("The catalog includes maps, prints and letters.", False), ("They spread more butter on the bread.", False),
    ("Ask the_log in which all was written down.", False), ("The log in2 is not a word of theirs at all.", False),
    ("Please sign in to see the rest of this page.", True), ("Login to see the rest of this page.", True),
    ("Read more: the story of the house.", True), ("Text ©2024 by the people of the house.", True)])
def test_boilerplate_is_whole_words(line, fails):
    assert line_rules.line_fails(line, word_list(line)) == fails


def test_oracle_says_the_same_on_borders(spark):
    lines = ["The design in this house is older.", "Please sign in.", "é log in é of the house today.", "blog inside the house today, they say.",
             "(Sign up) for more of it all, please.", "sign_in is no phrase of theirs at all.", "Text ©2024 by the people of it all.", "read more2 of it all in there today.",
             "Read more", "über uns: privacy policyé of it all today."]
    rows = [(i, " ".join(["One plain line of ten words is here for all."] * 1) + "\n" + x) for i, x in enumerate(lines)]
    own = {r.doc_id: r.n_failed_lines for r in line_rules.line_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    found = con.execute(f"select doc_id, n_failed_lines from ({queries.ORACLES['op7_line_rules']})").fetchall()
    assert dict(found) == own


def test_line_first_on_hard_rows(docs, empty):
    rows = line_rules.line_first(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        ws = word_list(r.text)
        lines = [x for x in (r.text or "").split("\n") if word_list(x)]
        assert (r.n_words, r.word_chars) == (len(ws), sum(map(len, ws)))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", r.text or ""))
        assert r.base_failed == (len(ws) < 10 or 100 * r.n_repeat_words > 20 * len(ws))
        assert not (r.kept and r.base_failed)
    assert line_rules.line_first(empty).count() == 0


# --- 8: packing -------------------------------------------------------------------------------

@given(st.lists(st.integers(1, 50), max_size=60))
@settings(max_examples=100, deadline=None)
def test_first_fit_is_first_fit(lengths):
    lengths = sorted(lengths, reverse=True)
    room, want = [50] * len(lengths), []
    for n in lengths:
        k = next(i for i, r in enumerate(room) if r >= n)
        room[k] -= n
        want.append(k)
    assert packing.first_fit(lengths, 50) == want


def packed_whole(rows, docs_ids):
    spans, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        spans[r.doc_id].append((r.start, r.length, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    return spans, sequences


def test_packing_of_hard_rows(docs, empty):
    pieces = packing.token_pieces(docs, queries.vocabulary())
    rows = packing.pack(pieces, group_pieces=16).collect()
    spans, sequences = packed_whole(rows, None)
    assert spans[9] and sum(n for _, n, _ in spans[9]) == spans[9][0][2]
    ids = b"".join(bytes(r.ids) for r in sorted((r for r in rows if r.doc_id == 9), key=lambda r: r.start))
    whole = packing.encoder(queries.vocabulary("byte_bpe_50k.json"))([LONG])[0] + [1]
    assert np.frombuffer(ids, "<u4").tolist() == whole
    assert len(spans[None]) == 2 and len(spans[0]) == 2  # null ids and repeated rows are all packed
    assert packing.pack(packing.token_pieces(empty, queries.vocabulary())).count() == 0
    clashing = packing.pack(pieces.withColumns({"_row": F.lit("a"), "_group": F.lit("b"), "offset": F.lit(9)}))
    assert {(r._row, r._group) for r in clashing.collect()} == {("a", "b")}


def test_both_vocabulary_files_give_the_same_ids(spark, sf_dir):
    texts = [r.text or "" for r in queries.table(spark, sf_dir, "documents").select("text").limit(150).collect()]
    texts += ["", " ", "\n\n  x", "a" * 3000, "\U0001F600 é ß", "don't we'll I'M", "<|endoftext|>", "  tabs\t\tand\r\nlines", "　\xa0x", "12 345,6"]
    assert packing.encoder(queries.vocabulary())(texts) == packing.encoder(queries.vocabulary("byte_bpe_50k.json"))(texts)


def test_ids_are_those_of_tokenizers():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext|", "x" + " " * 1_200_000 + "y", "\n" * 1_200_000,
             "x" + " \t" * 50_000, "it's 12 o'clock  here"]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 220, 50256, 275]
    assert packing.encoder(queries.vocabulary())(texts) == want
    assert packing.encoder(queries.vocabulary("byte_bpe_50k.json"))(texts) == want


def test_packing_wastes_little(spark, sf_dir):
    rows = queries.op8_packing(spark, sf_dir).collect()
    _, sequences = packed_whole(rows, None)
    used = sum(n for s in sequences.values() for _, n in s)
    assert used > 0.97 * 2048 * len(sequences)


# --- 9: n-gram Jaccard join -------------------------------------------------------------------

def plain_join(rows, similarity=0.8):
    sets = []
    for _, text in rows:
        ws = word_list(text)
        sets.append({tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} - {()})
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and shared >= similarity * (len(sets[a]) + len(sets[b]) - shared) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = collections.defaultdict(list)
    for k in range(len(rows)):
        least[find(k)].append(rows[k][0])
    out = []
    for k, (i, _) in enumerate(rows):
        known = [x for x in least[find(k)] if x is not None]
        out.append((i, (min(known) if known else None) if sets[k] else i, links[k]))
    return sorted(out, key=str)


def near_copies():
    rng = random.Random(4)
    base = [f"v{rng.randrange(300)}" for _ in range(120)]
    rows = []
    for i in range(90):
        own = list(base)
        for _ in range(rng.randrange(5)):
            own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
        rows.append((i + 100, " ".join(own[:rng.choice([120, 120, 110, 60])])))
    return rows + [(i + 200, " ".join(f"u{rng.randrange(10**6)}" for _ in range(40)) + " " + " ".join(base[:30])) for i in range(20)]


@pytest.mark.parametrize("block, broadcast", [(256, 10**6), (7, 10**6), (256, 0)])
def test_join_matches_brute_force(spark, block, broadcast):
    rows = near_copies() + [r[:2] for r in hard_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = similar.join_similar(docs, block=block, max_broadcast=broadcast).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == plain_join(rows)


def test_join_of_the_table_matches_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = queries.op9_ngram_jaccard_join(spark, sf_dir).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == plain_join(rows)


def test_one_of_each_on_hard_rows(docs, empty):
    kept = similar.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    classes = {c for _, c, _ in plain_join([r[:2] for r in hard_rows() if word_list(r[1])])}
    assert sum(bool(word_list(r.text)) for r in rows) == len(classes)
    assert sum(not word_list(r.text) for r in rows) == sum(not word_list(r[1]) for r in hard_rows())
    assert similar.one_of_each(empty).count() == 0


def test_one_of_each_keeps_unlinked_texts_under_one_id(spark):
    texts = ["one two three four five six", "seven eight nine ten eleven twelve", "alpha beta gamma", "alpha beta gamma"]
    for key in (None, 7):
        rows = similar.one_of_each(spark.createDataFrame([(key, t) for t in texts], "doc_id long, text string")).collect()
        assert sorted(r.text for r in rows) == sorted(set(texts)) and {r.doc_id for r in rows} == {key}


@pytest.mark.parametrize("block", [256, 7])
def test_classes_without_links_match_brute_force(spark, block):
    """Chains and families that rounds leave open are finished in cells; n_links is then null."""
    rng = random.Random(8)
    chain, rows = [f"c{k}" for k in range(60)], near_copies() + [r[:2] for r in hard_rows()]
    for i in range(60):
        chain = chain[:-3] + [f"c{i}_{k}" for k in range(3)] if i % 9 else chain[3:] + [f"e{i}_{k}" for k in range(3)]
        rows.append((i + 400, " ".join(chain)))
    family = [f"f{k}" for k in range(90)]
    rows += [(i + 500, " ".join(family[:60] + [f"g{rng.randrange(4)}_{k}" for k in range(14)])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = similar.join_similar(docs, block=block, links=False).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=str) == [(i, c) for i, c, _ in plain_join(rows)]
    assert all(r.n_links is None for r in got)


def test_rows_of_the_class_search_are_bounded_by_the_class(spark, monkeypatch):
    """No table of a class of near copies has more rows than texts times bands; buckets, than that in each round."""
    written = collections.Counter()

    def counted(df, label="cut"):
        out = cut_lineage(df, label)
        written[label] += out.count()
        return out

    monkeypatch.setattr(similar, "cut_lineage", counted)
    rng, rows = random.Random(2), []
    base = [f"v{rng.randrange(300)}" for _ in range(200)]
    for i in range(1200):
        own = list(base)
        for _ in range(rng.randrange(1, 5)):
            own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    found = similar.join_similar(spark.createDataFrame(rows, "doc_id long, text string"), block=64, links=False)
    assert found.select("component").distinct().count() == 1
    # met: the shared buckets and what each round leaves open
    assert written["met"] <= 3 * 24 * 1200 and max(written[x] for x in ("pairs", "links", "cells")) <= 24 * 1200, written


def test_bands_reach_the_recall():
    for s, recall in ((0.8, 0.9999), (0.5, 0.9), (0.9, 0.999)):
        bands, rows = similar.choose_bands(s, recall)
        assert 1 - (1 - s ** rows) ** bands >= recall and bands * rows <= 128


# --- 10: licences -----------------------------------------------------------------------------

def plain_scan(text, templates, threshold=licences.THRESHOLD):
    lines = [x for x in re.sub(r"[^\w\n]+|_+", " ", (text or "").lower()).split("\n") if " " in x.strip()]
    units = lines + [" ".join(lines)] * (len((text or "").split("\n")) > 1 and len(lines) > 1)
    best = []
    for u in units:
        w = u.split()
        own = {" ".join(p) for p in zip(w, w[1:])}
        scored = [(2 * len(own & set(t.bigrams)) / (len(own) + len(t.bigrams)), len(t.bigrams), t.name) for t in templates if t.name not in licences.PASSAGES]
        good = sorted((-d, -n, name) for d, n, name in scored if d >= threshold - 1e-12)
        best += good[:1]
    w, places = re.sub(r"[\W_]+", " ", (text or "").lower()).split(), {}
    for t in templates:
        for start in range(-t.words, len(w)):
            if any(w[max(start + k, 0):start + k + 2] == a.split() for a, k in t.anchors if start + k >= 0):
                cut = w[max(start, 0):start + t.words]
                own = {" ".join(p) for p in zip(cut, cut[1:])}
                d = 2 * len(own & set(t.bigrams)) / (len(own) + len(t.bigrams))
                if d >= threshold - 1e-12:
                    places.setdefault(start, []).append((-d, -len(t.bigrams), t.name))
    both = best + [min(p) for p in places.values()]
    return (min(both)[2] if both else None, len(best), len(places), sorted({b[2] for b in both}))


def wrapped(text, width, mark=""):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def test_licences_within_longer_texts(spark):
    prose = "The ferry leaves at noon and returns before dark, so bring a coat and something to eat. " * 20
    code = "\n".join(f"value_{k} = compute({k})" for k in range(50))
    t = licences.TEMPLATES | licences.PASSAGES
    apache = wrapped("Copyright 2020 The Authors", 70, "# ") + "\n#\n" + wrapped(t["Apache-2.0-header"], 70, "# ")
    cases = [
        (f"MIT License\n\nCopyright (c) 2020 Someone\n\n{wrapped(t['MIT-text'], 78)}\n\nTHE SOFTWARE IS PROVIDED \"AS IS\"", "MIT-text"),
        (f"{apache}\n#\n\n{code}", "Apache-2.0-header"),
        (f"/*\n{wrapped(t['MPL-2.0'], 70, ' * ')}\n */\n{code}", "MPL-2.0"),
        (f"{prose}{t['GPL-3.0-header']} {prose}", "GPL-3.0-header"),
        (f"{prose}\n\n{wrapped(t['BSD-3-Clause-text'], 72, '// ')}\n\n{prose}", "BSD-3-Clause-text"),
        (f"1. Definitions.\n\n      {wrapped(t['Apache-2.0-terms'], 66, '      ')}\n\n{prose}", "Apache-2.0-terms"),
        (f"{prose} this work is licensed under the GNU General Public License, version 3, as is the map. {prose}", "GPL-3.0"),
        (prose, None), (code, None), (prose + "Some rights reserved by 4 people. " + prose, None)]
    frame = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan_licences(frame).collect()}
    for k, (text, name) in enumerate(cases):
        assert got[k].licence == name, text
        assert list(got[k].licences) == plain_scan(text, licences.template_bigrams(t))[3]
    assert list(got[6].licences) == ["GPL-3.0"]


def test_licences_of_hard_rows(spark, docs, empty):
    mit = licences.TEMPLATES["MIT-text"]
    texts = [r[1] for r in hard_rows()] + [mit, mit.upper(), mit.replace("grant", "lend"), f"x y\n{mit}", "released under the mit license!!",
                                            "Licensed under CC BY-SA 4.0", "All Rights Reserved\nmore prose here", "all rights", "Released  under\tthe-MIT license"]
    texts += [f"{a} {mit} {b}" for a in ("", "some prose here,") for b in ("", "and more of it")] + [
        "this work is licensed under the gnu general public license version 3 " * 3, "rights reserved", "by 4", " ".join([mit] * 40)]
    texts += [wrapped(t, 60, mark) for t in (licences.TEMPLATES | licences.PASSAGES).values() for mark in ("", "# ")]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    templates = licences.template_bigrams(licences.TEMPLATES | licences.PASSAGES)
    for r in licences.scan_licences(frame).collect():
        assert (r.licence, r.n_matches, r.n_passages, list(r.licences)) == plain_scan(texts[r.doc_id], templates), texts[r.doc_id]
    assert licences.scan_licences(docs).count() == docs.count()
    assert licences.scan_licences(empty).count() == 0
    assert licences.scan_licences(docs, templates={}).filter("licence is not null").count() == 0


# --- queries and oracles ----------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, sf_dir).toPandas(), con.execute(queries.ORACLES[name]).df()
    names = sorted(got.columns)
    assert names == sorted(want.columns)

    def plain(frame):
        return sorted(str([None if v is None or v != v else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
                           for v in row]) for row in frame[names].astype(object).where(frame[names].notna(), None).values.tolist())

    assert plain(got) == plain(want)
