"""The training-data operators against brute force, round trips and held-out
rows, with the defined edge cases."""

import hashlib
import os
import random
import tracemalloc
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riverflow.llm import (
    kernel, langid, linedup, pfair, pu, quotes, simhash, superminhash, tagpath, tokenbin, winnow,
)
from riverflow.llm.common import components
from tests.llm import brute

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, slice_ int, row_ string"


def edge_docs(spark, seed=3):
    """NULLs in every column, empty and long texts, ties, repeated rows, extra
    columns whose names clash with internal ones."""
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    base = [" ".join(rnd.choice(vocab) for _ in range(60)) for _ in range(6)]
    rows = [(1, None), (2, ""), (3, "   \n\t"), (4, "one"), (5, "a b c d"), (6, base[0]), (7, base[0]),
            (8, base[0] + " tail"), (9, base[1].upper()), (10, base[1]), (11, "!!! ??? 123"), (12, "日本語 テキスト"),
            (13, "x y " * 20000), (14, "\n".join([base[2], base[3], base[4]])), (15, "\n".join([base[2], base[3], "new line"])),
            (16, "\n".join([base[3], base[4]])), (6, base[0]), (17, "it's \"quoted\" <|endoftext|> é÷ß")]
    rows = [(i, t, "en" if i % 3 else None, None if i % 4 == 0 else f"s{i % 2}", None, 0, "x") for i, t in rows]
    rows.append((None, base[5], None, None, None, None, None))
    return spark.createDataFrame(rows, DOC)


def empty_docs(spark):
    return spark.createDataFrame([], DOC)


def local(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- words and components

def test_words_match_the_contract_patterns():
    texts = ["", "A b-c9 É", "x y z", "tab\tnl\nvt\x0bff\x0ccr\rend", "é\x7fß", "  lead", "ünï 日本"]
    raw, off = kernel.utf8(pa.array(texts))
    for pattern, kind in ((brute.words_nonspace, kernel.NONSPACE), (brute.words_alnum, kernel.ALNUM)):
        words = kernel.Words(raw, off, kind)
        got = [[words.word(i) for i in range(words.ptr[t], words.ptr[t + 1])] for t in range(len(texts))]
        assert got == [pattern(t) for t in texts]


def test_components_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 40)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 5 for i in range(5, 40)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- op1

def test_simhash_matches_plain_edit_and_neighbours(spark, docs):
    from riverflow.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op1_simhash"](spark, SF).collect()}
    rows = sorted(local(docs))
    prints = [int(got[d].fingerprint, 16) for d, _ in rows]
    for i, (d, t) in enumerate(rows):
        t, before = t or "", rows[i - 1][1] or ""
        k = len(t) // 3
        edited = t[:len(t) - k] + before[:k]
        assert (got[d].n_chars, got[d].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert got[d].near_next == 1 - (prints[i] ^ prints[i - 1]).bit_count() / 64
        assert got[d].near_edited == 1 - (prints[i] ^ int(got[d].edited_fingerprint, 16)).bit_count() / 64
        if d % 20 == 0:
            assert got[d].n_near == sum((prints[i] ^ p).bit_count() <= 3 for p in prints) - 1
    same = {}
    for (d, t), p in zip(rows, prints):
        assert same.setdefault(t, p) == p


def test_simhash_search_finds_all_within_radius(spark):
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(20)]
    prints = set(base)
    for b in base:
        for _ in range(30):
            x = b
            for bit in rnd.sample(range(64), rnd.randint(1, 5)):
                x ^= 1 << bit
            prints.add(x)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    corpus = spark.createDataFrame([(signed(x), 2) for x in prints], "fingerprint long, n long")
    got = {r.fingerprint: (r.n_near, r.near_docs) for r in simhash.near_search(corpus, corpus, group=7).collect()}
    for x in prints:
        want = sum(0 < (x ^ y).bit_count() <= 3 for y in prints)
        assert got.get(signed(x), (0, 0)) == (want, 2 * want)


def test_simhash_edges(spark):
    rows = simhash.edited_fingerprints(edge_docs(spark)).collect()
    assert len(rows) == 19
    by = {r.doc_id: r for r in rows}
    assert by[1].fingerprint == by[2].fingerprint == by[3].fingerprint == 0 and by[1].n_chars == 0
    assert by[6].fingerprint == by[7].fingerprint
    assert simhash.edited_fingerprints(empty_docs(spark)).count() == 0
    one = simhash.edited_fingerprints(edge_docs(spark).where("doc_id = 8")).collect()
    assert len(one) == 1 and one[0].next_fingerprint == one[0].fingerprint


# --- op2

@pytest.mark.parametrize("short", [False, True])
def test_winnowing_matches_brute_force(spark, docs, short):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = local(docs) + [(900, items[0][1]), (901, "x " + items[1][1].lower() + " y"), (902, items[2][1][:80])]
    if short:
        items += [(9001, "the of"), (9002, rows[3][1][:200]), (9003, None), (9004, "and"), (9005, items[0][1]), (9006, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contamination(rows, items)
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in winnow.decontaminate(table, bench).collect()}
    assert got == want
    assert any(v[1] for v in want.values())


def test_winnowing_edges(spark):
    bench = spark.createDataFrame([(None, "w1 w2"), (1, None)], "item_id long, text string")
    out = winnow.decontaminate(edge_docs(spark), bench)
    assert out.count() == 19
    assert not out.where("doc_id in (1, 2, 3) and (contaminated or n_words > 0)").count()
    assert winnow.decontaminate(empty_docs(spark), bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert winnow.decontaminate(edge_docs(spark), none).where("contaminated").count() == 0


# --- op3

def test_elias_fano_round_trip():
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 0), (1, 10 ** 9), (5, 5), (1000, 10 ** 6), (3000, 3000)):
        values = np.sort(rng.integers(0, top + 1, n))
        ef = tokenbin.EliasFano(n, *tokenbin.EliasFano.encode(values))
        assert (ef.all() == values).all()
        assert all(ef.select(i) == values[i] for i in range(n))


def test_encoder_equals_the_library():
    encoder = tokenbin.Encoder(tokenbin.vocabulary())
    rng = np.random.default_rng(1)
    signs = list("ab1, \n\té'.")
    texts = ["", " ", "\n\n x", "don't", "tab\t\tx \n", "日本語 text", "<|endoftext|> a", "café × ÷z", "\x1c a \x85 b", "a\x7fb"]
    texts += ["".join(rng.choice(signs, rng.integers(0, 40))) for _ in range(500)]
    raw, off = kernel.utf8(pa.array(texts))
    want = [e.ids for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(raw, off)] == want
    assert [x.tolist() for x in encoder.encode(raw, off)] == want


def plain_tokens(rows):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenbin.vocabulary())
    at, out = 0, []
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_file_round_trip(spark, docs):
    rows = local(edge_docs(spark).where("doc_id is not null").dropDuplicates(["doc_id"])) + [
        (d + 1000, t) for d, t in local(docs)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    out = tokenbin.round_trip(table, tokenbin.vocabulary(), block_tokens=500).collect()
    assert [tuple(r) for r in sorted(out, key=lambda r: r.start)] == plain_tokens(sorted(rows, key=lambda r: r[0]))
    assert tokenbin.round_trip(empty_docs(spark), tokenbin.vocabulary()).count() == 0
    assert tokenbin.round_trip(edge_docs(spark), tokenbin.vocabulary()).count() == 19


# --- op4

def test_langid_on_held_out_rows(spark):
    from riverflow.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op4_langid"](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 100
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


def test_langid_edges(spark):
    docs = edge_docs(spark)
    model = langid.fit(docs)
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 11))
    assert got[12].lang_pred == "en"
    nothing = langid.fit(docs.where("lang = 'xx'"))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(empty_docs(spark), model).count() == 0


def test_langid_words_are_the_same_on_both_sides(spark):
    rows = [(1, "l’eau «quoted» हिन्दी", "fr"), (2, "wind\u00a0blows “hard”", "en")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    model.gram_logs[:] = 0          # only words met in training can decide
    docs = spark.createDataFrame([(1, "“eau”"), (2, "«hard»"), (3, "हिन्दी—quoted"), (4, "blows…")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score > 0.5) for r in langid.identify(docs, model).collect()}
    assert got == {1: ("fr", True), 2: ("en", True), 3: ("fr", True), 4: ("en", True)}


def test_langid_keeps_all_words_of_the_sample(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c + d for a in letters for b in letters for c in letters for d in letters[:4]]     # 70,304
    model = langid.fit(spark.createDataFrame([(1, " ".join(words), "en")], "doc_id long, text string, lang string"))
    assert len(model.keys) == len(words)


# --- op5

def ideal(sizes: dict, weights: dict):
    """After each slot, what each source should have: every slot is shared by
    weight among the sources that are not used up, in steps between ends."""
    got, left, t, total = dict.fromkeys(sizes, Fraction(0)), dict(sizes), Fraction(0), sum(sizes.values())
    at = 1
    while at <= total:
        alive = {s: Fraction(weights[s]) for s in sizes if got[s] < sizes[s]}
        whole = sum(alive.values())
        step = min([at - t] + [(sizes[s] - got[s]) * whole / w for s, w in alive.items()])
        for s, w in alive.items():
            got[s] += step * w / whole
        t += step
        if t == at:
            yield dict(got)
            at += 1


def test_slots_deviate_less_than_one_block():
    rnd = random.Random(2)
    for _ in range(25):
        sizes = {s: rnd.randint(1, 40) for s in range(rnd.randint(1, 8))}
        weights = {s: rnd.randint(1, 60) for s in sizes}
        seen = dict.fromkeys(sizes, 0)
        order = list(pfair.slots([(sizes[s], weights[s]) for s in sizes]))
        assert len(order) == sum(sizes.values())
        for (s, i), want in zip(order, ideal(sizes, weights)):
            assert i == seen[s]
            seen[s] += 1
            assert all(abs(seen[x] - want[x]) < 1 for x in sizes)


def test_slots_keep_tiny_weights_of_many_sources():
    # 1,000 sources of 0.0001, and one of 0.9 with 9,000 blocks: all end together
    order = [s for s, _ in pfair.slots(list(zip([9000] + [1] * 1000, pfair.whole([0.9] + [0.0001] * 1000))))]
    large = np.cumsum(np.array(order) == 0)
    assert np.abs(large - 0.9 * np.arange(1, 10001)).max() < 1
    # 10,000 sources of random weights: one block of deviation at most while none is used up
    rnd = random.Random(3)
    weights = np.array([rnd.random() ** 4 + 1e-6 for _ in range(10_000)])
    weights /= weights.sum()
    seen = np.zeros(len(weights))
    for t, (s, _) in enumerate(pfair.slots([(20_000, w) for w in pfair.whole(list(weights))]), 1):
        seen[s] += 1
        if t % 997 == 0:
            assert np.abs(seen - t * weights).max() < 1 + 1e-9
        if t == 20_000:
            break


def test_schedule_matches_a_replay(spark):
    sizes = {"a": 700, "b": 150, None: 90, "c": 3}
    rows = [(i, s, "t") for i, s in enumerate(x for x, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = pfair.schedule(docs, {"a": 0.25, "b": 0.5, "z": 0.1}, block_docs=4).collect()
    assert sorted(r.doc_id for r in out) == list(range(len(rows)))
    spare = {s: sizes[s] ** 0.7 for s in (None, "c")}
    weights = {"a": 0.25, "b": 0.5} | {s: 0.25 * w / sum(spare.values()) for s, w in spare.items()}
    blocks = {s: -(-n // 4) for s, n in sizes.items()}
    by_slot = {}
    for r in out:
        by_slot.setdefault(r.slot_, set()).add((r.source, r.block_))
    assert sorted(by_slot) == list(range(sum(blocks.values()))) and all(len(v) == 1 for v in by_slot.values())
    seen = dict.fromkeys(sizes, 0)
    for t, want in enumerate(ideal(blocks, weights)):
        (s, i), = by_slot[t]
        assert i == seen[s]
        seen[s] += 1
        assert all(abs(seen[x] - want[x]) < 1 + 1e-9 for x in sizes)
    assert pfair.schedule(docs, block_docs=4, max_blocks=10).agg(F.max("block_")).first()[0] < 10


def test_schedule_takes_many_sources(spark):
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 4000).alias("source"), F.lit("t").alias("text"))
    out = pfair.schedule(docs, block_docs=1).collect()
    assert len(out) == len({r.slot_ for r in out}) == 12_000


def test_schedule_edges(spark):
    out = pfair.schedule(edge_docs(spark), block_docs=2)
    assert out.count() == 19 and len(out.select("slot_", "place_").distinct().collect()) == 19
    assert pfair.schedule(empty_docs(spark)).count() == 0


# --- op6

def test_line_dedup_matches_brute_force(spark):
    rnd = random.Random(4)
    pool = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.choice([2, 3, 25]))) for _ in range(14)] + ["", "  "]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 9)))) for i in range(60)]
    rows += [(i + 100, t) for i, t in rows[:5]] + [(200, "\n".join(["same"] * 12))]
    for m in (1, 3, 4):
        got = linedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_lines=m).collect()
        assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in got} == brute.line_dedup(rows, min_lines=m)


def test_maximal_runs_match_brute_force(spark):
    rnd = random.Random(8)
    rows = [(i, "\n".join(rnd.choice("abcdef") for _ in range(rnd.randint(0, 12)))) for i in range(30)]
    rows += [(90, "\n".join("abcabcabcabcabc")), (91, rows[0][1] + "\nz\n" + rows[1][1]), (92, "\n".join(["same"] * 21))]
    seqs = [(d, [x for x in t.split("\n") if x]) for d, t in rows]
    places = [(d, a, s[a:]) for d, s in seqs for a in range(len(s))]
    longest = {}
    for i, (d, a, s) in enumerate(places):
        longest[d, a] = max((next((n for n, (x, y) in enumerate(zip(s, o)) if x != y), min(len(s), len(o)))
                             for _, _, o in places[:i]), default=0)
    want = {(d, a, n) for (d, a), n in longest.items() if n and longest.get((d, a - 1), 0) <= n}
    got = linedup.maximal_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(want) and {(r.doc_id, r.seq, r.length) for r in got} == want
    assert linedup.maximal_runs(empty_docs(spark)).count() == 0


def test_line_dedup_edges(spark):
    got = linedup.dedup_lines(edge_docs(spark)).collect()
    assert len(got) == 19
    by = {r.doc_id: r for r in got}
    assert by[1].text is None and by[2].text == "" and by[7].n_removed == 1 and by[15].text == "new line"
    assert linedup.dedup_lines(empty_docs(spark)).count() == 0


# --- op7

def test_quotes_are_linked(spark):
    rows = [(1, 0, "user", "Hello there\nhow are you?"), (1, 1, "assistant", "I am fine.\n\nThanks a lot."),
            (1, 2, "user", "> I am   FINE.\ngood\n> thanks a lot."), (1, 3, "user", "On Monday A wrote:\n> how are you?\n>> gone\nwell"),
            (1, 4, None, None), (2, 5, "user", "x"), (None, 1, "user", "> x"), (1, 9, "a", ">> I am fine.\n> good\nok"),
            (1, 10, "a", "> ok"), (1, 10, "a", "> ok")]
    out = quotes.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    got = {(r.conv_id, r.turn): (r.content, r.n_quotes, r.n_linked, r.reply_to, r.thread, r.depth) for r in out}
    assert len(out) == len(rows)
    assert got[(1, 2)] == ("good", 2, 2, 1, 0, 2)
    assert got[(1, 3)] == ("well", 2, 1, 0, 0, 1)
    assert got[(1, 4)] == ("", 0, 0, 3, 0, 2)
    assert got[(1, 9)] == ("ok", 2, 2, 2, 0, 3)
    assert got[(1, 10)] == ("", 1, 1, 9, 0, 4)
    assert got[(2, 5)] == ("x", 0, 0, None, 5, 0)
    assert got[(None, 1)] == ("", 0, 0, None, 1, 0)
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert quotes.link(none).count() == 0


# --- op8

def test_pu_on_held_out_rows(spark):
    from riverflow.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op8_pu"](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.score, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    good, poor = [s for s, q in held if q], [s for s, q in held if not q]
    assert sum((a > b) + 0.5 * (a == b) for a in good for b in poor) >= 0.97 * len(good) * len(poor)


def test_pu_edges(spark):
    labels = spark.createDataFrame([(6, 1, 0), (9, 0, 0), (None, 1, 0), (10, None, 0)], "doc_id long, quality int, toxic int")
    docs = edge_docs(spark)
    out = pu.score(docs, pu.fit(docs, labels)).collect()
    assert len(out) == 19 and len({r.score for r in out if r.doc_id in (1, 2)}) == 1
    assert {r.score for r in pu.score(docs, pu.fit(docs, labels.where("quality = 0"))).collect()} == {0.0}
    assert pu.score(empty_docs(spark), pu.fit(empty_docs(spark), labels)).count() == 0


# --- op9

def test_tagpath_keeps_the_article():
    page = ("<html><head><title>x</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul>"
            "<li><a>Home</a></ul></nav><div class='ad'>Buy this now, please.</div><article><h1>Title &amp; more</h1>"
            "<p><b>First text, with\n  many words in it.<br><p>Short.</p><p>Another paragraph, long enough to count.</p>"
            "<div class='comments'><p>Nice one, thanks!</p></div></article><aside>Side</aside>"
            "<form>Search <input></form><footer>&copy; us, 2020.</footer></body></html>")
    assert tagpath.main_text(page) == ("Title & more\n\nFirst text, with many words in it.\n\nShort.\n\n"
                                       "Another paragraph, long enough to count.")
    plain = page.replace("<article>", "<div class='c'>").replace("</article>", "</div>")
    assert "Short." in tagpath.main_text(plain) and "Buy" not in tagpath.main_text(plain)


LONG = "%s sentence, with a good many words in it, and more. It goes on, and on, for a while. " * 4


def long_texts(*names):
    return "".join(f"<p>{LONG.replace('%s', n)}</p>" for n in names)


def starts(page):
    return [x.split()[0] for x in tagpath.main_text(page).split("\n\n") if x]


def test_tagpath_selects_inside_articles():
    page = (f"<body><article><h1>Title</h1>{long_texts('A', 'B')}<div><ul><li><a href=x>Tag one</a><li><a href=y>Tag two</a>"
            f"</ul></div><ul><li>Take the first item, then wait.</ul><p>Short <a href=z>linked</a> end.</p></article>"
            f"<article>{long_texts('C')}</article></body>")
    assert starts(page) == ["Title", "A", "B", "Take", "Short", "C"]
    assert "Short linked end." in tagpath.main_text(page)


def test_tagpath_keeps_split_text_and_named_wrappers():
    assert starts(f"<body><div><div>{long_texts('A', 'B', 'C')}</div></div><div><div>{long_texts('D', 'E')}</div></div></body>") == list("ABCDE")
    items = long_texts("A", "B", "C").replace("p>", "li>")
    assert starts(f"<body><div><ul>{items}</ul>{long_texts('D')}</div></body>") == list("ABCD")
    for name in ("class='layout with-sidebar'", "class=no-comments", "class='post-header'", "id=notice-board", "class=sidebar"):
        assert starts(f"<body><div {name}><article>{long_texts('A')}</article></div><div class=sidebar>{long_texts('X')}</div></body>") == ["A"]
        assert starts(f"<body><div {name}>{long_texts('A', 'B')}</div><div class='ad-box'>{LONG}</div></body>") == ["A", "B"]


def test_tagpath_loses_nothing_inside_articles():
    math_ = "<math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math>"
    cases = [("<table><tr><td>One</td><td>2</td></tr></table>", ["One", "2"]), ("<ul><li>Salt</li><li>Oil</li></ul>", ["Salt", "Oil"]),
             ("<pre>x = 1</pre>", ["x = 1"]), ("<figure><img><figcaption>A boat</figcaption></figure>", ["A boat"]),
             ("<blockquote>Be.</blockquote>", ["Be."]), ("<dl><dt>A</dt><dd>b</dd></dl>", ["A", "b"]),
             ("<div><span>Short</span> <span>spans</span></div>", ["Short spans"]), ("<p class='ad-hoc'>Committee.</p>", ["Committee."]),
             (f"<p>Energy is {math_} and</p>", ["Energy is E=mc2 and"]),
             ("<ul><li><a href=x>One</a><li><a href=y>Two</a></ul>", []), ("<div class='ad-box'>Buy.</div>", [])]
    prose = " ".join(LONG.split())
    for html, texts in cases:
        for tag in ("article", "div"):
            page = f"<body><nav><a>Home</a></nav><{tag}><h1>T</h1><p>{LONG}</p>{html}<p>{LONG}</p></{tag}><footer>f</footer></body>"
            assert tagpath.main_text(page).split("\n\n") == ["T", prose, *texts, prose], (tag, html)
        page = f"<body><article><p>{LONG}</p>{html}</article><div>Tail</div></body>"       # at the article's end
        assert tagpath.main_text(page).split("\n\n") == [prose, *texts], html
    for named in ("<section id=search>", "<div class=related>"):
        page = f"<body><article><p>{LONG}</p>{named}<p>{LONG}</p>{'</section>' if 'section' in named else '</div>'}</article></body>"
        assert tagpath.main_text(page).split("\n\n") == [prose, prose]
        links = "<ul><li><a href=x>One more text</a><li><a href=y>Another</a></ul>"
        assert tagpath.main_text(page.replace(f"{named}<p>{LONG}</p>", named + links)) == prose


def test_tagpath_reads_deep_pages():
    for deep in ("<div>" * 8000 + "<p>Text, here.</p>" + "x</div>" * 8000, "<b>x" * 8000, "</i>" * 8000 + "<div>y" * 8000 + "</span>" * 8000):
        tracemalloc.start()
        assert tagpath.main_text(deep)
        assert tracemalloc.get_traced_memory()[1] < 20e6
        tracemalloc.stop()


def test_tagpath_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain &lt;text&gt;"), (4, "u", "<p>unclosed <b>bold"), (5, "u", "<"),
            (None, "u", "<script>x"), (3, "u", "plain &lt;text&gt;"), (6, "u", "<a href=\"x" * 2000)]
    out = tagpath.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(out) == 8
    by = {r.page_id: r.text for r in out}
    assert by[1] == by[2] == by[None] == "" and by[3] == "plain <text>" and by[4] == "unclosed bold"
    assert all(r.n_chars == len(r.text) for r in out)


# --- op10

def test_near_duplicates_match_brute_force(spark, docs):
    rnd = random.Random(9)
    vocab = [f"v{i}" for i in range(400)]
    rows = local(docs)
    for g in range(6):       # groups of near copies around a base, edited more and more
        base = [rnd.choice(vocab) for _ in range(rnd.choice([8, 40, 200]))]
        for e in range(25):
            copy = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 25))):
                copy[rnd.randrange(len(copy))] = f"e{g}_{e}_{rnd.randrange(99)}"
            rows.append((1000 + 100 * g + e, " ".join(copy)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.near_components(rows)
    for options in ({}, {"block_docs": 4}):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in superminhash.near_duplicates(table, **options).collect()}
        assert got == want


def test_superminhash_estimates_likeness():
    rng = np.random.default_rng(3)
    pool = kernel.mix(rng.integers(1, 1 << 62, 3000).astype(np.uint64))
    for n, share in ((20, 0.5), (300, 0.8), (1500, 0.3)):
        common = int(2 * n * share / (1 + share))
        a, b = pool[:n], pool[n - common:2 * n - common]
        sig = superminhash.signatures([np.unique(a), np.unique(b)])
        true = common / (2 * n - common)
        assert abs((sig[0] == sig[1]).mean() - true) < 0.15


def test_near_duplicate_edges(spark):
    got = superminhash.near_duplicates(edge_docs(spark)).collect()
    assert len(got) == 19
    by = {r.doc_id: r for r in got}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0 and by[1].kept and by[3].kept
    assert by[7].component_id == 6 and by[10].component_id == 9 and by[None].kept
    assert superminhash.near_duplicates(empty_docs(spark)).count() == 0


# --- hashes

def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_regular_words_never_meet(spark, n):
    """Words that collide under every polynomial hash modulo 2**64."""
    one, two = thue_morse(n)
    raw, off = kernel.utf8(pa.array([one, two]))
    assert len(set(kernel.Words(raw, off, kernel.NONSPACE).hash.tolist())) == 2
    docs = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string").coalesce(1)
    got = sorted(tuple(r) for r in tokenbin.round_trip(docs, tokenbin.vocabulary()).collect())
    assert got == plain_tokens([(1, one), (2, two)])
    assert {r.component_id for r in superminhash.near_duplicates(docs).collect()} == {1, 2}
    model = langid.Model(["x", "y"], [("x", one, 5), ("y", two, 5)], [], {("x", 0): 5, ("y", 0): 5})
    assert [r.lang_pred for r in langid.identify(docs, model).orderBy("doc_id").collect()] == ["x", "y"]


def test_equal_hashes_are_never_trusted(monkeypatch):
    """With a hash that makes most pieces collide the ids stay right."""
    monkeypatch.setattr(kernel, "span_hashes", lambda data, start, end, places=None: ((end - start) % 3).astype(np.uint64))
    texts = ["plain words go here", "other words come here too", "", "a b c 12 345", "plain words go here"]
    raw, off = kernel.utf8(pa.array(texts))
    encoder = tokenbin.Encoder(tokenbin.vocabulary())
    for _ in range(2):
        got = encoder.encode(raw, off)
        assert [g.tolist() for g in got] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


# --- pipeline

def test_pipeline_keeps_unrelated_texts_of_one_id(spark):
    import corpus_pipeline as cp
    rnd = random.Random(8)
    a, b, c = (" ".join(rnd.choice("abcdefgh") * 3 + str(rnd.randint(0, 99)) for _ in range(40)) for _ in range(3))
    rows = [(7, a), (7, b), (7, a), (None, c), (None, c), (9, c + " tail"), (8, None), (8, "")]
    docs = spark.createDataFrame([(d, t, None, "s", 0) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(((r.doc_id, r.text) for r in cp.near_dedup(spark, docs, SF).collect()), key=str)
    assert kept == sorted([(7, a), (7, b), (9, c + " tail"), (8, None), (8, "")], key=str)


def test_pipeline_names_unknown_languages(spark, docs):
    import corpus_pipeline as cp
    some = docs.select("doc_id", "text", F.when(F.col("doc_id") % 3 == 0, None).otherwise(F.col("lang")).alias("lang"), "source", "n_chars")
    before = {r.doc_id: (r.lang, r.text) for r in docs.select("doc_id", "lang", "text").collect()}
    got = {r.doc_id: r.lang for r in cp.language_id(spark, some, SF).select("doc_id", "lang").collect()}
    assert len(got) > 190
    named = [d for d in got if d % 3 == 0 and before[d][0] is not None and len(before[d][1].split()) > 20]
    assert sum(got[d] == before[d][0] for d in named) >= 0.95 * len(named) > 0
    assert all(got[d] == before[d][0] for d in got if d % 3)


def test_pipeline_stages_match_brute_force(spark, tmp_path_factory):
    import corpus_pipeline as cp
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = os.path.join("/tmp", f"riverflow-pipe-{random.getrandbits(40):x}")
    kept, frame = local(docs), docs
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    for k, (name, step) in enumerate(cp.STAGES):
        step(spark, frame, SF).write.parquet(f"{base}/{k}")
        frame = spark.read.parquet(f"{base}/{k}")
        if k < 4:
            assert frame.columns == cp.COLUMNS
        if name == "language_id":
            kept = [(d, t) for d, t in kept if any(c.isalpha() for c in t or "")]
        elif name == "near_dedup":
            found = brute.near_components(kept, percent=80)
            kept = [(d, t) for d, t in kept if found[d][2]]
        elif name == "decontamination":
            found = brute.contamination(kept, items)
            kept = [(d, t) for d, t in kept if not (found[d][1] and 20 * found[d][1] >= found[d][0])]
        elif name == "mixing":
            order = [r.doc_id for r in pfair.schedule(spark.read.parquet(f"{base}/{k - 1}")).orderBy("slot_", "place_").collect()]
        if k < 4:
            assert sorted(r.doc_id for r in frame.collect()) == sorted(d for d, _ in kept)
    text = dict(kept)
    got = sorted((tuple(r) for r in frame.collect()), key=lambda r: r[1])
    assert got == plain_tokens([(d, text[d]) for d in order])


def test_pipeline_near_dedup_links_from_080(spark):
    import corpus_pipeline as cp
    rnd, rows = random.Random(5), []
    for g in range(40):      # chains: neighbours at 0.80 to 0.85, the ends below 0.80
        words = [f"g{g}_{i}" for i in range(104)]
        for e in range(3):
            rows.append((10 * g + e, " ".join(words)))
            for at in ((12, 57) if e == 0 else (34, 80)):
                words[at] = f"e{g}_{e}_{rnd.randrange(99)}"
    want = {d for d, f in brute.near_components(rows, 80).items() if f[2]}
    assert len(want) == 40 and sum(f[2] for f in brute.near_components(rows).values()) == 120
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in cp.near_dedup(spark, docs, SF).collect()} == want


def test_pipeline_without_labels_keeps_texts_with_letters(spark):
    import corpus_pipeline as cp
    docs = edge_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = cp.language_id(spark, docs, SF).where("doc_id is not null")
    want = [(d, t) for d, t in local(docs) if d is not None and any(c.isalpha() for c in t or "")]
    assert want and sorted(local(kept)) == sorted(want)


def test_pipeline_judges_rows_not_ids(spark):
    import corpus_pipeline as cp
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy(F.length("text").desc()).first().text
    rows = [(1, "!!!"), (1, "a clean text"), (2, bench), (2, "another clean text"), (None, "123"), (None, bench),
            (None, "no id here"), (None, "no id here"), (3, "z one"), (3, "b one"), (4, "x y"), (None, "x y")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    key = lambda r: (str(r[0]), r[1])
    got = {name: sorted(local(step(spark, docs, SF)), key=key) for name, step in cp.STAGES[:3]}
    assert got["language_id"] == sorted((r for r in rows if any(c.isalpha() for c in r[1])), key=key)
    assert got["decontamination"] == sorted((r for r in rows if r[1] != bench), key=key)
    # texts of one id are documents of their own; copies without an id go
    assert got["near_dedup"] == sorted([*rows[:4], (None, "123"), (None, "no id here"), (3, "z one"), (3, "b one"),
                                        (4, "x y")], key=key)


def test_pipeline_on_edge_rows(spark):
    import corpus_pipeline as cp
    base = os.path.join("/tmp", f"riverflow-pipe-{random.getrandbits(40):x}")
    for n, frame in enumerate((edge_docs(spark), empty_docs(spark))):
        for k, (_, step) in enumerate(cp.STAGES):
            step(spark, frame, SF).write.parquet(f"{base}/{n}-{k}")
            frame = spark.read.parquet(f"{base}/{n}-{k}")
        assert frame.count() == (0 if n else len({r.doc_id for r in frame.collect()}))


def test_op3_learns_pieces_by_the_bytes_of_their_ids():
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokenbin.vocabulary())

    class Fast:
        calls = 0

        def encode_batch_fast(self, *args, **named):
            return plain.encode_batch_fast(*args, **named)

        def encode(self, *args, **named):
            Fast.calls += 1
            return plain.encode(*args, **named)

    texts = [" ".join(f"wörd{i} {i * 7919}, x" for i in range(500)), "\n".join(f"lone{i}" for i in range(450)),
             "".join(f" a{i}" for i in range(200)), "", " ", "one"]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for known in (True, False):
        encoder = tokenbin.Encoder(tokenbin.vocabulary())
        encoder.tokenizer, Fast.calls = Fast(), 0
        if not known:
            encoder.long[:] = 0
        alone = [encoder.encode(np.frombuffer(r, np.uint8), np.array([0, len(r)]))[0].tolist() for r in raw]
        assert alone == want
        encoder._clear()
        assert [x.tolist() for x in encoder.encode(np.frombuffer(b"".join(raw), np.uint8), off)] == want
        assert (Fast.calls == 0) == known
