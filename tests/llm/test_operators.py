"""The operators for training text: brute force on small fixtures, odd rows, empty tables."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import common, components, decontaminate, exact_dedup, language_id, license_scan, near_copies, packing, passages, simhash, suffix_dedup, token_store, url_filter
from quire.llm.common import keep_rows

#: Nulls, empty, white space, ties, repeated rows, clashing names of other columns.
SCHEMA = "doc_id long, text string, lang string, source string, key long, th long, t string, row string, n long"
RNG = np.random.default_rng(7)
WORDS = ["".join(RNG.choice(list("abcdefghij"), 5)) for _ in range(400)]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


LONG = prose(300, 1)
TEXTS = [
    (1, "a b  c\n\td", "en"), (2, "abcd", "en"), (3, "abcd", None), (3, "abcd", None), (4, None, "en"), (5, "", None), (6, " \n", "fr"), (None, "abcd", "en"), (None, None, None),
    (7, LONG, "en"), (8, LONG + " x", "en"), (9, prose(90, 2) + " " + " ".join(LONG.split()[50:150]) + prose(80, 3), "fr"), (10, "12 34 ?!", "en"), (11, "é’s it's\r\nx\ty <|endoftext|> 　", "de"), (12, "short text of five words", "en"),
    (13, "Licensed under the Apache License, Version 2.0. All rights reserved", "en"), (14, prose(5000, 4), "en"), (15, prose(5000, 4), "en"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, g, "src", 0, 0, "x", "y", 1) for i, t, g in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_token_store(docs, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path())
    store = token_store.write_tokens(docs, path(), 2)
    found = store.documents().orderBy("start").collect()
    wanted = sorted(((i is not None, i or 0), tuple(t.encode(x or "", add_special_tokens=False).ids) + (2,)) for i, x, _ in TEXTS)
    got = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert got == [k for k, _ in wanted]
    assert sum(r.n_tokens for r in found) == sum(len(x) for _, x in wanted)
    assert Counter((r.doc_id, r.ids_crc32) for r in found) == Counter((i, zlib.crc32(np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4").tobytes())) for i, x, _ in TEXTS)
    assert [x.tolist() for x in store.get(2)] == [t.encode("abcd", add_special_tokens=False).ids + [2]]
    assert len(store.get(3)) == 2 and len(store.get(None)) == 2 and store.get(99) == []
    assert token_store.write_tokens(none, path(), 2).documents().collect() == []


def test_token_store_extreme_keys(spark):
    """A null key and the smallest number beside each other, and repeated."""
    rows = [(None, "a"), (-(2**63), "b"), (5, "c"), (None, "d"), (2**63 - 1, None), (-(2**63), "b")]
    store = token_store.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path(), 2)
    assert [len(store.get(k)) for k in (None, -(2**63), 5, 2**63 - 1, 0)] == [2, 2, 1, 1, 0]
    assert [r.doc_id for r in store.documents().orderBy("start").collect()] == [None, None, -(2**63), -(2**63), 5, 2**63 - 1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab ,.'s\n\té1\0", max_size=30), max_size=6))
def test_encoder(texts):
    from tokenizers import Tokenizer

    encoder, t = token_store._encoder(path(), 2), Tokenizer.from_file(path())
    ids, sizes = encoder.encode(pa.array(texts, pa.string()))
    wanted = [t.encode(x, add_special_tokens=False).ids + [2] for x in texts]
    assert ids.tolist() == [y for x in wanted for y in x] and sizes.tolist() == [len(x) for x in wanted]


def test_encoder_without_collections():
    """Learning pieces runs no garbage collection, of which each would walk over the ids of all pieces; it is on again afterwards."""
    import gc

    encoder, seen = token_store.Encoder(path(), 2), []
    learned, encoder._ids = encoder._ids, lambda pieces: (seen.append(gc.isenabled()), learned(pieces))[1]
    ids, sizes = encoder.encode(pa.array(["one two, three; four?! 5. ..,\n'six' .", None, "ten!"]))
    assert seen == [False] and gc.isenabled()
    whole = [encoder.tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in ("one two, three; four?! 5. ..,\n'six' .", "", "ten!")]
    assert ids.tolist() == sum(whole, []) and sizes.tolist() == list(map(len, whole))


def test_perfect_hash():
    keys = np.unique(RNG.integers(0, 2**63, 20000)).astype(np.uint64)
    h = token_store.PerfectHash.build(keys)
    assert sorted(h.slot(keys).tolist()) == list(range(len(keys)))


def test_golay_keys():
    """All pairs within 4 bits share a key."""
    a = RNG.integers(0, 2**63, 3000).astype(np.uint64)
    for bits in range(5):
        b = a.copy()
        for i in range(len(b)):
            for p in RNG.choice(64, bits, replace=False):
                b[i] ^= np.uint64(1) << np.uint64(p)
        known = set(zip(*(x.tolist() for x in simhash.keys_of(a)), strict=True))
        hit = {r for r, k in zip(*(x.tolist() for x in simhash.keys_of(b)), strict=True) if (r, k) in known}
        assert len(hit) == len(a)


def test_simhash(docs, none):
    from xxhash import xxh64_intdigest

    found = simhash.near_duplicates(docs).collect()
    fp = {}
    for i, t, _ in TEXTS:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        h = [xxh64_intdigest(b" ".join(w[k : k + 4]), 42) for k in range(max(1, len(w) - 3))] if w else []
        fp[(i, t)] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert Counter((r.key, r.fp % 2**64) for r in found) == Counter((i, fp[(i, t)]) for i, t, _ in TEXTS)
    rows = [(i, fp[(i, t)]) for i, t, _ in TEXTS]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if bin(rows[a][1] ^ rows[b][1]).count("1") <= 4:
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    least = {g: min((rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None), default=None) for g in group}
    assert Counter((r.key, r.component_id) for r in found) == Counter((rows[k][0], least[group[k]]) for k in range(len(rows)))
    assert simhash.near_duplicates(none).collect() == []


def test_near_copies(spark, docs, none):
    """Against all pairs, on texts near and far from the threshold, a bucket that is dealt to blocks included."""
    texts = []
    for i in range(40):
        base = prose(int(RNG.integers(6, 400)), 1000 + i).split()
        texts.append(" ".join(base))
        for edits in (1, len(base) // 60, len(base) // 20):
            words = list(base)
            for at in RNG.integers(0, len(words), edits):
                words[at] = "edited"
            texts.append(" ".join(words))
    rows = list(enumerate(texts)) + [(500, None), (501, ""), (502, texts[0]), (502, texts[0]), (None, texts[1])]
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (t.lower().split() for t in texts)]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    wanted = {i: find(i) for i in range(len(texts))}
    for block in (2048, 3):
        near_copies.BLOCK = block
        found = near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {r.key: r.component_id for r in found if r.key is not None and r.key < 500} == wanted
        assert len(found) == len(rows) and sum(r.kept for r in found if r.key is not None and r.key < 500) == len(set(wanted.values()))
        assert {r.component_id for r in found if r.key == 502 or r.key is None} == {0}
    near_copies.BLOCK = 2048
    assert near_copies.near_copies(docs).count() == len(TEXTS)
    assert near_copies.near_copies(none).count() == 0


def test_near_copies_on_a_template(spark):
    """Texts of one template, just below the threshold to each other, in pairs just above it."""
    template, texts = prose(300, 77).split(), []
    for i in range(110):
        words = list(template)
        for x in range(4):  # two texts share one of their places at most, those of a pair the word as well
            y = (i // 2 % 11 + (2 * (i // 22) + i % 2) * x) % 11
            words[6 * (11 * x + y) + 5] = f"own{i}" if x else f"pair{i // 2}"
        texts.append(" ".join(words))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in map(str.split, texts)]
    like = [[b for b in range(len(texts)) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])] for a in range(len(texts))]
    wanted = list(range(len(texts)))
    for _ in texts:
        wanted = [min(wanted[b] for b in x) for x in like]
    assert len(set(wanted)) > 40 and all(wanted[a] == wanted[a + 1] for a in range(0, len(texts), 2))
    for block in (2048, 50):
        near_copies.BLOCK = block
        found = {r.key: r.component_id for r in near_copies.near_copies(rows).collect()}
        near_copies.BLOCK = 2048
        assert found == dict(enumerate(wanted))


def test_components(spark, none):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (500, 501), (501, 500)]
    found = {r.v: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[k] == 100 for k in range(100, 160)) and found[501] == 500
    assert components.components(none.selectExpr("doc_id u", "key v")).collect() == []


def test_exact_dedup(docs, none):
    for digest in (False, True):
        found = exact_dedup.exact_dedup(docs, digest=digest).collect()
        assert len(found) == len(TEXTS)
        groups = {}
        for i, t, _ in TEXTS:
            groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
        wanted = Counter()
        for members in groups.values():
            keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
            wanted.update((i, keep, len(members)) for i, _ in members)
        assert Counter((r.doc_id, r.keep_id, r.group_size) for r in found) == wanted
        assert sum(r.kept for r in found) == len(groups)
    assert {r.text_sha256 for r in found} == {hashlib.sha256(g.encode()).hexdigest() for g in groups}
    kept = keep_rows(docs, exact_dedup.exact_dedup(docs).select(F.col("doc_id").alias("key"), "th", "kept"), "doc_id", "text")
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_dedup(none).collect() == []


def test_suffix_dedup(docs, none, spark):
    found = suffix_dedup.digest(suffix_dedup.suffix_dedup(docs)).collect()
    windows = Counter(b[s : s + 400] for b in ((t or "").encode() for _, t, _ in TEXTS) for s in range(len(b) - 399))
    wanted = Counter()
    for i, t, _ in TEXTS:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 399):
            if windows[b[s : s + 400]] > 1:
                gone[s : s + 400] = b"\x01" * 400
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        wanted[(i, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())] += 1
    assert Counter(tuple(r) for r in found) == wanted
    assert suffix_dedup.digest(suffix_dedup.suffix_dedup(none)).collect() == []
    same = spark.createDataFrame([(1, "ab" * 500), (2, "x" * 399), (3, "x" * 401)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in suffix_dedup.digest(suffix_dedup.suffix_dedup(same)).collect()} == {1: 1000, 2: 0, 3: 401}


def test_merge():
    rows = [bytes(RNG.choice(list(b"ab"), int(RNG.integers(1, 30))).tolist()) for _ in range(300)]
    parts = [sorted(rows[i::7]) for i in range(7)]
    order = list(suffix_dedup.merge([suffix_dedup.Run(i, *suffix_dedup.front_code(p)) for i, p in enumerate(parts)]))
    merged = [parts[r][i] for r, i, _ in order]
    assert merged == sorted(rows)
    assert all(n == suffix_dedup.shared(a, b, 0) for a, b, (_, _, n) in zip(merged, merged[1:], order[1:], strict=False))


def test_language(spark, docs, none):
    rows = spark.createDataFrame([(i, "the house and the water" if i % 2 else "das haus und das wasser", "en" if i % 2 else "de") for i in range(60)], "doc_id long, text string, lang string")
    model = language_id.fit(rows)
    names, score = language_id.predict(model, ["the water", "das wasser und", None, "", "12 ?", "the house and the water and the house das haus und das wasser und das wasser und das haus"])
    assert names[:2] == ["en", "de"] and names[2:5] == ["und"] * 3 and score[2:5].tolist() == [0, 0, 0]
    spans = language_id.language_spans(rows.where("doc_id < 2").groupBy().agg(F.lit(1).alias("doc_id"), F.array_join(F.array_sort(F.collect_list(F.repeat(F.concat("text", F.lit(" ")), F.lit(4)))), "").alias("text")), model).orderBy("first_word").collect()
    assert [s.lang for s in spans] == ["de", "en"]
    found = language_id.identify(docs, language_id.fit(docs)).collect()
    assert len(found) == len(TEXTS) and {r.lang_pred for r in found if r.key in (4, 5, 6, 10)} == {"und"}
    assert {r.lang_pred for r in language_id.identify(docs, language_id.fit(none)).collect()} == {"und"}
    assert language_id.keep_identified(docs, language_id.fit(docs)).columns == docs.columns


def test_language_bounds_memory(monkeypatch):
    import tracemalloc

    rng = np.random.default_rng(8)
    model = language_id.Model(["a", "b"], rng.normal(size=(language_id.BUCKETS, 2)).astype(np.float32), np.ones((len(language_id.SCRIPTS), 2), bool))
    text = " ".join(map("".join, rng.choice(list("abcdefghijklmnopqrstuvwxyz"), (100_000, 9)).tolist()))  # no word twice
    tracemalloc.start()
    whole = language_id.predict(model, [text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * len(text), peak / len(text)

    texts = ["w" * 50, None, text[:3000], "", "eins zwei, drei 4 vier" * 9, text[3000:9000], " ", "w" * 50 + " " + text[:300]]
    together = language_id.spans(model, texts)
    monkeypatch.setattr(language_id, "PIECE", 7)
    monkeypatch.setattr(language_id, "SCORED", 20)
    monkeypatch.setattr(language_id, "KNOWN", 100)
    assert [[w for x in language_id._words(t) for w in x] for t in texts] == [language_id._WORD.findall(t or "") for t in texts]
    known = language_id.Known(model)
    each = [language_id.spans(model, [t], known=known) for t in texts]
    for i in range(3):
        assert np.array_equal(np.concatenate([x[i] for x in each]), together[i])
    assert language_id.predict(model, [text])[0] == whole[0] and language_id.predict(model, [text])[1].tolist() == whole[1].tolist()


def test_viterbi_is_exact():
    for _ in range(30):
        n, m = int(RNG.integers(1, 7)), 3
        scores = -RNG.random((n, m)).astype(np.float32) * 3
        best = max(itertools.product(range(m), repeat=n), key=lambda p: sum(scores[i, k] for i, k in enumerate(p)) - 1.5 * sum(a != b for a, b in itertools.pairwise(p)))
        assert language_id.viterbi(scores, np.array([n]), 1.5).tolist() == list(best)


def test_masks_find_all_pairs_of_substitutions():
    for gone in itertools.combinations(range(13), 2):
        assert any(all(mask[j] == "0" or at + j not in gone for j in range(len(mask))) for mask in decontaminate.MASKS for at in range(13 - len(mask) + 1))


def test_decontaminate(spark, docs, none):
    item = prose(30, 50)
    words = item.split()
    words[5] = words[20] = "zzz"
    rows = spark.createDataFrame([(1, prose(50, 51) + " " + item.upper() + " " + prose(9, 52)), (2, prose(20, 53) + " " + " ".join(words)), (3, prose(200, 54)), (4, None), (5, "a short item of six words")], "doc_id long, text string")
    items = spark.createDataFrame([(10, item), (11, None), (12, "short item of six words"), (13, "")], "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.contaminated(rows, items).collect()}
    assert set(found) == {1, 2, 5} and found[1].n_words == 30 and found[1].identity == 1 and found[2].item_ids == [10] and found[5].item_id == 12
    assert {r.doc_id for r in decontaminate.contaminated(rows, items, block=40).collect()} == {1, 2, 5}
    assert decontaminate.contaminated(none, items).collect() == [] and decontaminate.contaminated(rows, items.where("false")).collect() == []
    assert decontaminate.contaminated(docs, items).collect() == []


def test_all_overlaps():
    """Runs that substituted words keep apart, and short items with substituted words, at their ends too."""
    item = [f"w{i}" for i in range(76)]

    def found(item, gone):
        index = decontaminate.Index.build([(1, " ".join(item))])
        text = "before it " + " ".join("other" if i in gone else w for i, w in enumerate(item)) + " after it"
        return [x[2:] for x in decontaminate.find(index, [b"nothing here", text.encode()])]

    for n, gone in ((49, {*range(13, 18), *range(31, 36)}), (76, {*range(20, 28), *range(48, 56)})):
        parts = found(item[:n], gone)
        assert sum(p[2] for p in parts) >= n - len(gone) and all(p[2] >= 13 and p[3] >= 0.8 for p in parts) and all(p[0] == p[1] + 2 for p in parts)
    for n in range(5, 14):
        for k in (0, 1, 2, 3):
            for gone in itertools.combinations(range(n), k):
                assert [p[:3] for p in found(item[:n], gone)] == ([(2, 0, n)] if 10 * k <= 2 * n else []), (n, gone)
    rng = np.random.default_rng(4)
    for _ in range(300):
        same = rng.random(int(rng.integers(13, 70))) < rng.uniform(0.6, 0.95)
        spans = [(x, y) for x in range(len(same)) for y in range(x + 13, len(same) + 1) if same[x] and same[y - 1] and 5 * same[x:y].sum() >= 4 * (y - x)]
        parts = decontaminate.stretches(same, 13)
        assert bool(parts) == bool(spans) and set(parts) <= set(spans)


def test_licenses(docs, none):
    assert len(license_scan.rules()) > 200
    found = {r.key: r for r in license_scan.scan(docs).collect()}
    assert (found[13].base_labels, found[13].labels, found[13].n_base, found[13].first_word) == ("reserved", "apache-2.0,licensed-under,reserved", 1, 8)
    assert (found[4].n_words, found[4].first_word, found[4].labels, found[4].score) == (0, None, "", 0.0)
    assert len(found) == len({i for i, _, _ in TEXTS}) and license_scan.scan(none).collect() == []
    line, n = license_scan.words_line(b"CC-BY_cc by: General Public License")
    assert n == 7 and license_scan.base_places(line) == [(0, "cc-by"), (2, "cc-by"), (4, "gpl")]
    line, _ = license_scan.words_line(b"GNU General Public License version 3 or later")
    assert [d.label for d in license_scan.detect(line)] == ["gpl-3.0"]


def naive_fit(sizes, sources, clusters, capacity):
    bins, out = [], []
    for s, a, c in zip(sizes, sources, clusters, strict=True):
        fits = [(b["left"], i) for i, b in enumerate(bins) if b["left"] >= s and (a is None or a not in b["a"]) and (c is None or c not in b["c"])]
        i = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"left": capacity, "a": set(), "c": set()})
        bins[i]["left"] -= s
        bins[i]["a"].add(a)
        bins[i]["c"].add(c)
        out.append(i)
    return out


def test_suppression():
    """Against a test of all pairs, on a long text that repeats itself, in about linear time."""
    import time

    part = b"Licensed under the Apache License, Version 2.0 or the MIT license; GNU General Public License version 2 or later. CC BY SA 4.0 all rights reserved. "
    line, _ = license_scan.words_line(part * 3)
    machine, compiled = license_scan._machine()
    found = [(m.start(), m.end(), r.priority, i, r.label) for i, (r, p) in enumerate(compiled) if r.keyword in line.decode() for m in p.finditer(line)]
    kept = []
    for x in sorted(found, key=lambda x: (-x[2], x[0] - x[1], x[3], x[0])):
        if not any(a <= x[0] and x[1] <= b for a, b, *_ in kept):
            kept.append(x)
    wanted = sorted((line.count(b" ", 0, a), line.count(b" ", a, b), label) for a, b, _, _, label in kept)
    assert sorted((d.first, d.n_words, d.label) for d in license_scan.detect(line)) == wanted
    line, _ = license_scan.words_line(part * 35_000)  # 5 MB
    start = time.time()
    assert len(license_scan.detect(line)) > 100_000 and len(license_scan.base_places(line)) == 105_000 and time.time() - start < 60


def test_short_items(spark):
    items = spark.createDataFrame([(1, "one two three four"), (2, "Word"), (3, ""), (4, None)], "item_id long, text string")
    texts = spark.createDataFrame([(1, "x one two three four y"), (2, "one two three five"), (None, "a word."), (4, None), (5, "words")], "doc_id long, text string")
    assert {(r.doc_id, tuple(r.item_ids)) for r in decontaminate.contaminated(texts, items).collect()} == {(1, (1,)), (None, (2,))}


def test_folder_is_left_empty(docs, tmp_path, monkeypatch):
    """What an operator has written goes when it returns, but for what its result reads, and bitmaps."""
    import os

    monkeypatch.setattr(common, "shared_dir", lambda spark: f"file://{tmp_path}")
    simhash.near_duplicates(docs).collect()
    assert sorted(x.rsplit("-", 1)[0] for x in os.listdir(tmp_path)) == ["simhash", "simhash-classes"]


def test_packing_of_empty_texts(spark):
    """Empty texts are no copies of each other; equal rows don't meet in a bin if their source is known."""
    rows = [(k, None if k % 2 else " ", None) for k in range(50)] + [(99, "abc", "s")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = packing.pack(docs, F.octet_length("text"), F.col("source"), packing.cluster_of(F.col("text"))).collect()
    assert len(found) == 53 and len({r.bin_id for r in found}) == 3 and len({r.bin_id for r in found if r.key == 99}) == 3


def test_packing(spark, docs, none):
    for _ in range(20):
        n = 60
        sizes = sorted(RNG.integers(0, 50, n).tolist(), reverse=True)
        sources, clusters = [None if x == 0 else f"s{x}" for x in RNG.integers(0, 6, n)], [f"c{x}" for x in RNG.integers(0, 30, n)]
        assert packing.best_fit(sizes, sources, clusters, 100) == naive_fit(sizes, sources, clusters, 100)
    found = packing.pack(docs, F.octet_length("text"), F.col("doc_id"), packing.cluster_of(F.col("text")), capacity=1000, group=8).collect()
    assert Counter(r.key for r in found if r.piece == 0) == Counter(i for i, _, _ in TEXTS)
    total = Counter()
    for r in found:
        total[r.bin_id] += r.length
    assert max(total.values()) <= 1000 and sum(total.values()) == sum(len((t or "").encode()) for _, t, _ in TEXTS)
    assert packing.pack(none, F.octet_length("text"), F.col("source"), F.col("text")).collect() == []


def test_passages(spark, docs, none):
    shared = prose(70, 90).split()
    fuzzy = list(shared)
    fuzzy[30] = "zzz"
    del fuzzy[50]
    rows = spark.createDataFrame([(1, prose(80, 91) + " " + " ".join(shared) + " " + prose(60, 92)), (2, prose(40, 93) + " " + " ".join(fuzzy) + " " + prose(90, 94)), (3, prose(300, 95)), (4, None), (5, " ".join(shared[:30]))], "doc_id long, text string")
    found = passages.passages(rows).collect()
    assert [(r.key, r.other) for r in found] == [(2, 1)] and found[0].n_words >= 65 and found[0].identity > 0.9
    linked = {x for r in passages.passages(docs).collect() for x in (r.key, r.other)}
    assert {7, 8, 9, 14, 15} <= linked and passages.passages(none).collect() == []


def test_passages_whose_parts_come_first_elsewhere(spark):
    """Documents 3 and 4 share a passage whose seeds all occur earlier, in two others that hold less than a passage of it."""
    w = prose(64, 1).split()
    texts = [prose(30, 11) + " " + " ".join(w[:36]) + " " + prose(30, 12), prose(30, 13) + " " + " ".join(w[28:]) + " " + prose(30, 14)]
    texts += [prose(40, 15 + k) + " " + " ".join(w) + " " + prose(40, 25 + k) for k in range(2)]
    found = passages.passages(spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")).collect()
    assert [(r.key, r.other) for r in found] == [(4, 3)] and found[0].n_words >= 64


def test_passages_recall(spark):
    """Against brute force: of passages of 60 words of which some are substituted, planted in two texts each."""
    vocabulary = np.array(["w%d" % i for i in range(20_000)])
    for rate, least in ((0.0, 1.0), (0.05, 0.9), (0.1, 0.7)):
        rng, rows, planted = np.random.default_rng(int(rate * 100)), [], 0
        for k in range(60):
            p = rng.choice(vocabulary, 60)
            q = np.where(rng.random(60) < rate, rng.choice(vocabulary, 60), p)
            planted += 1
            rows += [(2 * k, " ".join([*rng.choice(vocabulary, 100), *p, *rng.choice(vocabulary, 100)])), (2 * k + 1, " ".join([*rng.choice(vocabulary, 50), *q, *rng.choice(vocabulary, 50)]))]
        found = {(r.key, r.other) for r in passages.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert found <= {(2 * k + 1, 2 * k) for k in range(60)} and len(found) >= least * planted


def test_passages_with_many_substitutions(spark):
    """Passages whose only common seeds are few: up to a fifth of 55 words substituted, and every 8th word of 64."""
    vocabulary = np.array(["w%d" % i for i in range(20_000)])
    for rate, least in ((0.15, 0.9), (0.2, 0.85), (None, 0.75)):
        rng, rows, planted = np.random.default_rng(5), [], set()
        while len(planted) < 60:
            p = rng.choice(vocabulary, 55 if rate else 64)
            q = np.where(rng.random(55) < rate if rate else np.arange(64) % 8 == 7, rng.choice(vocabulary, len(p)), p)
            k = len(planted)
            if (p == q)[[*range(2), *range(-2, 0)]].all() and (p == q).mean() >= 0.8 or not rate:
                planted.add((2 * k + 1, 2 * k))
                rows += [(2 * k, " ".join([*rng.choice(vocabulary, 100), *p, *rng.choice(vocabulary, 100)])), (2 * k + 1, " ".join([*rng.choice(vocabulary, 50), *q, *rng.choice(vocabulary, 50)]))]
        found = {(r.key, r.other) for r in passages.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert found <= planted and len(found) >= least * len(planted)


def test_passages_of_variants(spark):
    """Of each ten variants of a passage, all pairs that brute force aligns are found, not only those with the first."""
    rng, rows, wanted = np.random.default_rng(6), [], set()
    vocabulary = np.array(["w%d" % i for i in range(20_000)])
    for k in range(6):
        one = rng.choice(vocabulary, 90)
        texts = [np.where(rng.random(90) < 0.08, rng.choice(vocabulary, 90), one) for _ in range(10)]
        ids = [np.array([int(w[1:]) for w in t], np.uint32) for t in texts]
        wanted |= {(10 * k + i, 10 * k + j) for i in range(10) for j in range(i) if passages.enough(*passages.align(ids[i], ids[j]))}
        rows += [(10 * k + i, " ".join([*rng.choice(vocabulary, 30), *t, *rng.choice(vocabulary, 30)])) for i, t in enumerate(texts)]
    found = {(r.key, r.other) for r in passages.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(wanted) > 200 and len(found & wanted) >= 0.98 * len(wanted)


def test_passages_of_one_word_and_of_few_words(spark):
    """Runs of one word meet whatever their lengths; a text isn't a passage of itself; few words in all raise nothing."""
    rows = [(1, "a " * 30 + prose(20, 1)), (2, prose(30, 2) + " a" * 70 + " " + prose(9, 3)), (3, prose(12, 4) + " a" * 55 + " " + prose(60, 5)), (4, "a " * 200)]
    rows += [(10 + k, "a " * 20 + prose(30, 20 + k)) for k in range(20)]
    found = passages.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.key for r in found} | {r.other for r in found} == {2, 3, 4} and not any(r.key == r.other and abs(r.first_word - r.other_first_word) < 50 for r in found)
    for n in range(1, 40):
        text, at, _, _ = passages.seeds([[b"%d" % i for i in range(n)]])
        assert (len(at) > 0) == (n >= passages.SEED)


def test_short_chains_that_hold_a_passage():
    """What is left out before an alignment holds no passage, what is kept is every passage, off the chain's diagonal, too."""
    rng, pairs, ends, planted = np.random.default_rng(8), [], [], []
    for k in range(300):
        x, y, shift = rng.integers(0, 10**6, 122), rng.integers(0, 10**6, 122), int(rng.integers(-40, 41)) if k % 3 else 0
        y[58:64] = x[58:64]  # the chain
        if k % 2:
            at = np.arange(max(5, 5 - shift), min(117, 117 - shift))[:55]
            at = at[rng.random(len(at)) > 0.15]
            y[at + shift] = x[at]
        pairs.append((x.astype(np.uint32), y.astype(np.uint32)))
        ends.append((58, 64, 58, 64))
    good = passages.hopeful(pairs, ends)
    assert {f[0] for f in passages.every_passage(pairs, ends)} <= set(np.flatnonzero(good).tolist()) and good[1::2].mean() > 0.9 and not good[::2].any()


def test_word_hashes():
    """The words of all texts at once, as words_of cuts them: across blocks, and not across texts."""
    rng = np.random.default_rng(9)
    texts = ["".join(rng.choice(list("abAé '\n1_-"), rng.integers(0, 60))) for _ in range(3000)]
    texts[5:9] = ["", "Ab", "ab", "x" * (passages.BLOCK + 9) + " é ab"]
    for some in (texts, texts[:1], [""], []):
        words = [decontaminate.words_of(t.encode()) for t in some]
        ids, counts = passages.word_hashes(*common.utf8(pa.array(some, pa.string())))
        assert counts.tolist() == [len(w) for w in words]
        both = set(zip(itertools.chain.from_iterable(words), ids.tolist(), strict=True))
        assert len(both) == len({w for w, _ in both}) == len({h for _, h in both})


def test_common_words():
    """Against the plain recurrence; a pair that has too few words in common holds no passage."""
    rng, few = np.random.default_rng(10), 0
    for k in range(200):
        x, y = (rng.integers(0, (3, 40, 400)[k % 3], rng.integers(1, 90)).astype(np.uint32) for _ in range(2))
        if k % 2:
            y = np.concatenate([y[:10], np.where(rng.random(len(x)) < rng.random() / 2, 999, x), y[10:]]).astype(np.uint32)
        row = [0] * (len(y) + 1)
        for a in x.tolist():
            before, row = row, [0]
            for j, b in enumerate(y.tolist()):
                row.append(before[j] + 1 if a == b else max(row[j], before[j + 1]))
        assert passages.common_words(x, y) == row[-1]
        few += row[-1] < passages.WORTH
        assert row[-1] >= passages.WORTH or not passages.enough(*passages.align(x, y))
    assert 50 < few < 190


def test_along():
    """A walk over substitutions, an insertion and a deletion."""
    x = np.arange(300)
    y = np.concatenate([x[:100], [900, 901], x[102:150], [950, 951, 952], x[150:220], x[225:]])
    at, other, same = passages.along(x, y, 120, 120)
    assert (at[0], other[0], at[-1], other[-1]) == (0, 0, 300, len(y)) and same.sum() == 293 and (np.diff(at) >= 0).all() and (x[at[:-1]][same] == y[other[:-1]][same]).all()


def test_passages_around_gaps():
    """Both of two passages with different words between them, as one chain."""
    for n, gap in ((60, 31), (60, 40), (60, 59), (100, 70), (60, 60), (60, 110)):
        one, two = np.arange(n), 1000 + np.arange(n)
        x, y = (np.concatenate([one, own + np.arange(gap), two]).astype(np.uint32) for own in (5000, 9000))
        found = sorted(passages.every_passage([(x, y)], [(0, len(x), 0, len(y))]))
        assert len(found) == 2 and all(f[5] >= 0.8 and f[1] == f[3] and f[2] == f[4] for f in found)
        assert found[0][1] == 0 and found[0][2] >= n and found[1][1] <= n + gap and found[1][2] == len(x)
    x, y = np.concatenate([one, 5000 + np.arange(30), two]), np.concatenate([one, 9000 + np.arange(55), two])
    found = sorted(passages.every_passage([(x, y)], [(0, len(x), 0, len(y))]))
    assert len(found) == 2 and found[1][2] == len(x) and found[1][4] == len(y)


def test_url_filter(spark, none):
    listed = spark.createDataFrame([("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), (None, "/", "block")], "host string, path string, verdict string")
    urls = ["https://A.Example.org/es/1?x", "http://example.org/en/12#t", "http://example.org/en/2", "http://badexample.org/es/", "http://example.org", "nothing", None, "x://org/a://b", ""]
    pages = spark.createDataFrame([(i, u, 1, 2) for i, u in enumerate(urls)], "page_id long, url string, host long, row long")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, listed).collect()}
    assert found[0] == ("a.example.org", "/es/1", "example.org/es/", "block") and found[1] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert found[2][2:] == ("org/", "allow") and found[3][2:] == ("org/", "allow") and found[4] == ("example.org", "", None, "allow")
    assert found[5] == found[6] == found[8] == ("", "", None, "allow") and found[7][:2] == ("org", "/a://b")
    assert url_filter.judge(pages.where("false"), listed).collect() == [] and {r.verdict for r in url_filter.judge(pages, listed.where("false")).collect()} == {"allow"}
