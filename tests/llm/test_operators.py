"""Each operator against a brute-force version, and on nulls, empty and long texts, ties, repeated rows, empty tables
and extra columns with clashing names."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from footfall.llm import chat, common, decontamination, grammar_tokens, near_duplicates, packing, pages, passages, perplexity, quality_rules, token_counts, words
from footfall.llm.tokens import Encoder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, piece int, version string"
VOCABULARY = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re", "Sa", "té") for b in ("ba", "do", "fi", "gu", "ha,", "zo.")]


def prose(seed, n):
    chance = random.Random(seed)
    return " ".join(chance.choice(VOCABULARY) for _ in range(n))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def texts():
    base, shared = prose(1, 200), prose(2, 60)
    near = base.split(" ")
    near[50] = "changed"
    rows = {
        0: base, 1: base, 2: " ".join(near), 3: prose(3, 120) + "\n" + shared, 4: prose(4, 90) + "\n" + shared + " " + prose(5, 40),
        5: "", 6: None, 7: "one", 8: "one two three", 9: "One  two\tthree", 10: "na " * 300, 11: prose(6, 9000), 12: prose(7, 60) + " ### $$$ | %%%",
        13: prose(8, 70) + " idiot scum", 14: prose(9, 30), 15: "a\x1cb <|endoftext|> ½ ﬁ\xa0日本 don't", 16: "\n".join([prose(10, 12)] * 6),
    }
    return rows


@pytest.fixture(scope="module")
def rows_in():
    given = [(i, t, ("en", "de", None)[i % 3], "s", len(t or "")) for i, t in texts().items()]
    given += [(3, texts()[3], "en", "s", 1), (None, prose(11, 80), "en", "s", 1), (None, None, None, None, None)]
    return [(*r, True, 7, "x") for r in given]


@pytest.fixture(scope="module")
def docs(spark, rows_in):
    return spark.createDataFrame(rows_in, DOCS).repartition(3).persist()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def ids_of(text):
    return [*Encoder().tokenizer.encode(text or "", add_special_tokens=False).ids]


def crc(ids):
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


def test_encoder_equals_the_tokenizer():
    encoder = Encoder()
    assert encoder.by_word
    for text in [*texts().values(), "İ ΑΣΣ 'S é ß ÀÉ* ***'s a'b it's", "a\x85c x<|startoftext|>y"]:
        assert np.frombuffer(encoder.ids(text), dtype="<u4").tolist() == ids_of(text)


def test_packing(docs, rows_in, nothing):
    got = packing.pack(packing.pieces(docs)).toPandas()
    expected = collections.Counter()
    for doc_id, text, *_ in rows_in:
        ids = [*ids_of(text), 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            expected[doc_id, piece, start, len(part), crc(part)] += 1
    found = [(None if d != d else int(d), p, s, n, c) for d, p, s, n, c in zip(got.doc_id, got.piece, got.start, got.length, got.ids_crc32)]
    assert collections.Counter(found) == expected
    assert all(crc(ids) == c for ids, c in zip(got.ids, got.ids_crc32))
    ordered = got.sort_values(["sequence_id", "offset"])
    before = ordered.groupby("sequence_id").length.cumsum() - ordered.length
    assert (before == ordered.offset).all() and ordered.groupby("sequence_id").length.sum().max() <= 4096
    assert packing.pack(packing.pieces(nothing, with_ids=False)).count() == 0


def test_bins_never_overflow_and_close_the_fullest():
    chance, bins, fill = random.Random(0), packing.Bins(100, 8), collections.Counter()
    lengths = [chance.randint(1, 100) for _ in range(3000)]
    for length in lengths:
        at, offset = bins.place(length)
        assert fill[at] == offset and offset + length <= 100 and bins.open <= 8
        fill[at] += length
    assert len(fill) < 1.15 * sum(lengths) / 100


def test_grammar_tokens(spark, docs, rows_in, nothing, tmp_path):
    path = str(tmp_path / "tokens")
    grammar_tokens.write_tokens(docs, path, shard_tokens=2000)
    got = grammar_tokens.read_tokens(spark, path).orderBy("start").collect()
    ordered = sorted(rows_in, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for row, (doc_id, text, *_) in zip(got, ordered, strict=True):
        ids = [*ids_of(text), 2]
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"], row["ids"]) == (doc_id, start, len(ids), crc(ids), ids)
        start += len(ids)
    shard = max((grammar_tokens.Shard(r) for r in grammar_tokens.read_shards(spark, path).collect()), key=lambda s: s.sizes.max())
    assert len(shard.rules) and shard.expansions.min() >= 2
    i = int(shard.sizes.argmax())
    whole = shard.document(i).tolist()
    assert shard.span(i, 17, 333).tolist() == whole[17:333] and shard.span(i, 0, len(whole)).tolist() == whole
    empty = str(tmp_path / "empty")
    grammar_tokens.write_tokens(nothing, empty)
    assert grammar_tokens.read_tokens(spark, empty).count() == 0


def test_compression_round_trip():
    chance = np.random.default_rng(0)
    for first_rule, size in ((50_000, 20_000), (70_000, 5000), (10, 400)):
        ids = chance.zipf(1.3, size) % min(first_rule, 300)
        last = chance.random(size) < 0.01
        last[-1] = True
        symbols, ends, rules = grammar_tokens.compress(ids, last.copy(), first_rule)
        assert grammar_tokens.expand(symbols, rules, first_rule).tolist() == ids.tolist()
        assert len(symbols) < 0.9 * size and ends.sum() == last.sum()
        sizes = grammar_tokens.expansion_lengths(rules, first_rule)
        assert all(n == len(grammar_tokens.expand(np.array([first_rule + k]), rules, first_rule)) for k, n in enumerate(sizes))


def test_length_histogram(docs, rows_in, nothing):
    sums = token_counts.with_suffix_sums(token_counts.histogram(token_counts.encoded_lengths(docs, "lang"))).persist()
    lengths = collections.defaultdict(list)
    for _, text, lang, *_ in rows_in:
        lengths[lang].append(len(ids_of(text)))
    for r in sums.collect():
        own = lengths[r["grp"]]
        at_least = [n for n in own if n >= r["length"]]
        assert (r["n_docs"], r["docs_at_least"], r["tokens_at_least"]) == (own.count(r["length"]), len(at_least), sum(at_least))
        assert r["tokens_truncated"] == sum(min(n, r["length"]) for n in own)
    for r in token_counts.truncated_totals(sums, [0, 5, 100, 10**6]).collect():
        assert r["tokens"] == sum(min(n, r["context_limit"]) for n in lengths[r["grp"]])
    for r in token_counts.quantiles(sums, [0.5, 1.0]).collect():
        own = sorted(lengths[r["grp"]])
        assert r["length"] == own[math.ceil(r["level"] * len(own)) - 1]
    assert token_counts.with_suffix_sums(token_counts.histogram(token_counts.encoded_lengths(nothing, "lang"))).count() == 0


def brute_components(rows, above=85):
    sets = {}
    for doc_id, text in rows:
        w = words_of(text)
        own = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
        sets.setdefault(doc_id, []).append(own)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and any(s and t and 100 * len(s & t) >= above * len(s | t) for s in sets[a] for t in sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {d: root(d) for d in sets}, sets


def test_near_duplicates(spark, docs, rows_in, nothing):
    got = near_duplicates.near_duplicates(docs).collect()
    component, sets = brute_components([(d, t) for d, t, *_ in rows_in if d is not None])
    assert len(got) == len(rows_in)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == component[r["doc_id"]] and r["n_shingles"] in [len(s) for s in sets[r["doc_id"]]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert near_duplicates.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("threshold,sizes", [((85, 100), (11, 14, 20, 40)), ((80, 100), (9, 15, 41))])
def test_short_near_duplicates_are_all_found(spark, threshold, sizes):
    """Short texts with as many words appended as the threshold allows, and one more than that, under a common line."""
    given, linked = [], {}
    for k in range(600):
        n = sizes[k % len(sizes)]
        most = threshold[1] * (n - 4) // threshold[0] - (n - 4)
        more = most + (k % 5 == 0)
        own = [f"w{k}x{i}" for i in range(n)] if k % 3 else [*"one line that is in many texts".split(), *(f"w{k}x{i}" for i in range(n - 7))]
        given += [(2 * k, " ".join(own)), (2 * k + 1, " ".join(own + [f"w{k}y{i}" for i in range(more)]))]
        linked[2 * k + 1] = more <= most
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(df, threshold=threshold).collect()}
    assert all((got[i] == i - 1) == near for i, near in linked.items())


def test_prefix_keys_meet_in_every_linked_pair():
    chance, counts = np.random.default_rng(5), np.random.default_rng(6).integers(0, 9, near_duplicates.SLOTS)
    for above, below in ((85, 100), (80, 100), (1, 1), (1, 2)):
        for n in range(1, near_duplicates.FEW + 1):
            most = min(n * below // above, near_duplicates.FEW)
            for m in {n, most, (n + most) // 2}:
                common = -(-above * (n + m) // (above + below))
                if common > n:
                    continue
                v = chance.integers(0, 1 << 64, n + m - common, dtype=np.uint64)
                both = np.concatenate((np.sort(v[:n]), np.sort(v[n - common :])))
                x, y = near_duplicates.prefix_keys(both, np.array([0, n, n + m]), counts, (above, below))
                assert len(np.intersect1d(x, y))


def test_chains_and_hubs_of_near_duplicates(spark):
    """A hub whose copies are only near to it, a chain, and rows of one id with different texts."""
    chance, base = random.Random(5), prose(20, 150).split(" ")
    rows = [(500, " ".join(base))]
    for i in range(60):
        copy = list(base)
        for _ in range(2):
            copy[chance.randrange(150)] = f"x{chance.randrange(10**6)}"
        rows.append((501 + i, " ".join(copy)))
    chain = list(base[::-1])
    for i in range(12):
        chain[i * 12] = f"y{i}"
        rows.append((700 + i, " ".join(chain)))
    rows += [(900, " ".join(base)), (900, " ".join(base[::-1])), (901, "short text"), (902, "short text")]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    component, _ = brute_components(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == component


def test_collision_correction_and_register_estimates():
    chance = np.random.default_rng(3)
    common, own = chance.integers(0, 2**63, 4000, dtype=np.uint64), chance.integers(0, 2**63, 2000, dtype=np.uint64)
    a, b = np.unique(np.concatenate((common, own[:1000]))), np.unique(np.concatenate((common, own[1000:])))
    regs = near_duplicates.registers(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
    score, used = near_duplicates.estimates(regs[:1], regs[1:], np.array([len(a)]), np.array([len(b)]))
    assert abs(score[0, 0] - 4000 / 6000) < 0.15 and used[0, 0] == near_duplicates.BUCKETS


def test_passages(docs, nothing):
    found = passages.repeated_passages(docs)
    rows = found.collect()
    assert all(r["doc_id"] > r["source_id"] for r in rows)
    pairs = {(r["doc_id"], r["source_id"]) for r in rows}
    assert {(1, 0), (2, 0), (4, 3)} <= pairs and {d for d, _ in pairs} <= {1, 2, 4}
    cut = next(r for r in rows if (r["doc_id"], r["source_id"]) == (4, 3))
    assert cut["first_word"] == 90 and cut["last_word"] == 149
    shorter = passages.without_repeats(docs, found)
    assert shorter.columns == docs.columns and shorter.count() == docs.count()
    kept = {r["doc_id"]: r["text"] for r in shorter.collect() if r["doc_id"] is not None}
    assert kept[0] == texts()[0] and kept[1] == "" and kept[4].split() == (prose(4, 90) + " " + prose(5, 40)).split() and kept[6] is None
    assert passages.repeated_passages(nothing).count() == 0


def test_passages_meet_in_groups_of_any_size(spark, monkeypatch):
    """46 texts share 50 to 80 words: more partners than any few centres, in one block and in several."""
    common = prose(41, 80).split(" ")

    def fill(seed):
        return [f"u{seed}_{i}" for i in range(60)]

    rows = [(i, " ".join(fill(i) + common[15:65] + fill(i + 1000))) for i in range(40)]
    rows += [(100 + i, " ".join(fill(100 + i) + common + fill(2000 + i))) for i in range(6)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (400, "same " * 300), (401, "same " * 200)]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {}
    for r in found:
        got.setdefault((r["doc_id"], r["source_id"]), set()).update(range(r["first_word"], r["last_word"] + 1))
    ids = [*range(40), *range(100, 106)]
    assert {(x, y) for x in ids for y in ids if x > y} <= got.keys()
    assert all(set(range(60, 140)) <= got[100 + i, 100 + j] for i in range(6) for j in range(i))
    assert got[300, 0] == got[301, 0] == set(range(len(rows[0][1].split(" "))))
    assert got[401, 400] == set(range(200))
    monkeypatch.setattr(passages, "BLOCK_BYTES", 5 * passages.SHORT)
    again = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(again) == sorted(found)


def test_meetings_inside_runs_of_one_shingle_are_those_of_all_windows():
    chance = np.random.default_rng(2)
    for _ in range(40):
        own = [np.repeat(chance.integers(1, 9, 12).astype(np.uint64), chance.integers(1, 9, 12)) for _ in range(4)]
        values, bounds = np.concatenate(own), np.concatenate(([0], np.cumsum([len(o) for o in own])))
        ids = np.arange(4)
        got = {(x, y): sorted(h) for x, y, h in passages._meetings(values, bounds, ids, ids, False, 6, 3, 2)}
        keys, owners, places = passages._windows(values, bounds, 6, 3)
        met = collections.defaultdict(list)
        for i in range(len(keys)):
            for j in range(len(keys)):
                (a, c, b), (p, m, q) = places[i].tolist(), places[j].tolist()
                before, after = min(c - a, m - p), min(b - c, q - m)
                if keys[i] == keys[j] and owners[i] > owners[j] and before + after + 1 >= 6:
                    met[int(owners[i]), int(owners[j])].append((c - m, c - before, c + after))
        want = {}
        for pair, spans in met.items():
            if len(spans) >= 2:
                shifts = sorted({s for s, _, _ in spans})
                want[pair] = [(s, min(l for t, l, _ in spans if t == s), max(h for t, _, h in spans if t == s)) for s in shifts]
        assert got == want


def test_remembered_words_are_bounded_and_read_shards_in_one_look(monkeypatch):
    plain, known = Encoder(), Encoder()
    monkeypatch.setattr("footfall.llm.tokens.REMEMBERED", 50)
    given = [prose(i, 40).upper() + f" Wort{i % 7}s, x{i} {prose(i + 1, 3)}" for i in range(30)]
    for text in given:
        assert known.ids(text) == plain._whole(text)
        assert len(known.words) <= 100 and len(known.words.older) <= 100
    rows = [known.ids(text) + b"\2\0\0\0" for text in given * 20]
    shard = grammar_tokens.Shard(grammar_tokens._shard(0, 0, 0, list(range(len(rows))), rows, known.tokenizer.get_vocab_size()))
    assert shard.expansions.max() > 4 and len(shard.symbols) < 0.5 * sum(map(len, rows)) / 4
    assert [ids.astype("<u4").tobytes() for ids in shard.all()] == rows == [shard.document(i).astype("<u4").tobytes() for i in range(len(rows))]


def test_texts_meet_only_with_a_long_row_in_common_and_no_passage_is_lost():
    chance = np.random.default_rng(5)
    assert passages.longest_run(46, 5, 0.8) == 20
    sentence, passage = prose(51, 12).split(" "), prose(52, 120).split(" ")
    made = []
    for i in range(60):
        edited = list(passage)
        for at in chance.integers(0, 120, int(chance.integers(0, 5))):
            edited[at] = f"e{i}_{at}"
        middle = [sentence, edited, sentence * 9, ["one"] * int(chance.integers(2, 90))][i % 4]
        made.append(" ".join([f"a{i}_{k}" for k in range(50)] + middle + [f"b{i}_{k}" for k in range(50)]).encode())
    values, bounds = words.shingles(words.Words(made), 5)
    ids, block = np.arange(60), passages.Block(values, bounds)

    def found(runs):
        met = list(passages._meetings(values, bounds, ids, ids, False, 46, 16, 2, runs))
        return len(met), {(i, j, *p) for i, j, hulls in met for p in passages.common_passages(block, i, j, hulls, 46, 0.8)}

    every, few = found(None), found(passages._run_keys(values, bounds, 5, 46, 20))
    assert few[1] == every[1] and len({p[:2] for p in few[1]}) > 60 and few[0] < every[0]

    def keys(n):
        pair = [" ".join([f"{s}{k}" for k in range(60)] + passage[:n] + [f"{s}{k}" for k in range(60, 120)]).encode() for s in "xy"]
        owners, hashes = passages._run_keys(*words.shingles(words.Words(pair), 5), 5, 46, 20)
        return len(set(hashes[owners == 0]) & set(hashes[owners == 1]))

    assert keys(12) == keys(13) == 0 and all(keys(n) for n in range(24, 60))


def test_merged_spans_are_those_of_all_pairs_and_have_no_row_for_a_pair(spark, monkeypatch):
    common = prose(61, 90).split(" ")
    rows = [(i, " ".join([f"u{i}_{k}" for k in range(60)] + common[i % 4 * 5 : 60 + i % 3 * 10] + [f"v{i}_{k}" for k in range(60)])) for i in range(40)]
    rows += [(50, " ".join(common[:30] + ["x"] + common[30:])), (51, rows[3][1]), (52, rows[5][1] + " " + rows[6][1]), (53, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def cells(found):
        held = collections.defaultdict(set)
        for r in found:
            held[r["doc_id"], r["version"]].update(range(r["first_word"], r["last_word"] + 1))
        return held

    pairs = passages.repeated_passages(docs).collect()
    merged = passages.repeated_passages(docs, merged=True).collect()
    assert cells(merged) == cells(pairs) and len(pairs) > 600 and len(merged) < 60
    # In several blocks, which take turns.
    monkeypatch.setattr(passages, "BLOCK_BYTES", 8 * passages.SHORT)
    monkeypatch.setattr(passages, "TURN_BYTES", 1)
    seen = []
    given = passages._cells
    monkeypatch.setattr(passages, "_cells", lambda held: seen.append(given(held)) or seen[-1])
    assert cells(passages.repeated_passages(docs, merged=True).collect()) == cells(pairs)
    assert sorted(passages.repeated_passages(docs).collect()) == sorted(pairs)
    assert all(turns > 1 for *_, turns in seen)


def test_a_text_goes_once_to_each_group_it_has_hashes_of(spark):
    """Twenty texts with one passage and 2,000 with another: 2,020 moves and those between the blocks of the large group."""
    rows = [(i, 0, 0, 100) for i in range(20)] + [(i, 0, 1, 9000) for i in range(20, 2020)] + [(5, 0, 1, 100)]
    groups, cells, turns = passages._cells(spark.createDataFrame(rows, "doc_id long, version long, hub long, bytes long"))
    assert turns == 1 and groups.count() == 2020
    blocks = 1 + (2000 * 9000 + passages.SHORT) // passages.BLOCK_BYTES
    assert cells.count() == 20 + 2001 * blocks
    assert cells.where("one > two").isEmpty() and cells.where("block != one and block != two").isEmpty()
    assert {len(r["groups"]) for r in groups.where("doc_id = 5").collect()} == {2}


def test_overlaps_of_a_text_are_verified_as_those_of_each_pair(monkeypatch):
    chance = np.random.default_rng(8)
    base = [f"w{k}" for k in range(300)]
    made = []
    for i in range(50):
        text = list(base) if i % 2 else [f"a{i}_{k}" for k in range(70)] + base[40 : 110 + i] + [f"b{i}_{k}" for k in range(70)]
        for at in chance.integers(0, len(text), int(chance.integers(0, 12)) if i % 3 else 0):
            text[at : at + int(chance.integers(0, 3))] = [f"e{i}_{at}"] * int(chance.integers(0, 3))
        if i % 10 == 0:
            text += text[100:190] + ["one"] * 60
        made.append(" ".join(text).encode())
    values, bounds = words.shingles(words.Words(made), 5)
    ids, block = np.arange(50), passages.Block(values, bounds)
    one_by_one = collections.defaultdict(set)
    for i, j, hulls in passages._meetings(values, bounds, ids, ids, False, 46, 4, 2):
        one_by_one[i] |= {(j, *p) for p in passages.common_passages(block, i, j, hulls, 46, 0.8)}
    plain = 0
    for places in (passages.Overlaps.PLACES, 1000):
        monkeypatch.setattr(passages.Overlaps, "PLACES", places)
        for i, *met in passages._met(values, bounds, ids, ids, False, 46, 4, 2):
            overlaps = passages.Overlaps(block, i, *met, 46, 0.8)
            arrays, others = overlaps.every()
            plain += len(arrays[0])
            assert {*[(*map(int, p), 1.0) for p in zip(*arrays)], *others} == one_by_one[i]
            covered = np.zeros(len(block.texts[i]) + 4, dtype=bool)
            for _, a, b, *_ in one_by_one[i]:
                covered[a : b + 5] = True
            assert np.array_equal(overlaps.cover(5), covered)
    assert plain > 50 and sum(map(len, one_by_one.values())) > 600


def test_compact_windows_cover_every_subsequence_once():
    hashes = np.random.default_rng(1).integers(0, 50, 60)
    found = passages.compact_windows(hashes, 8)
    for i in range(60):
        for j in range(i + 7, 60):
            own = [w for w in found if w[0] <= i <= w[1] <= j <= w[2]]
            assert len(own) == 1 and hashes[own[0][1]] == hashes[i : j + 1].min()


def test_contamination(spark, docs, nothing):
    item = prose(2, 60).split(" ")
    bench = spark.createDataFrame(
        [(1, " ".join(item[10:40])), (1, " ".join(item[10:40])), (2, "one two THREE"), (3, ""), (4, None), (None, " ".join(item[:13])), (5, prose(99, 20))],
        "item_id long, text string",
    )
    got = {(r["doc_id"], r["n_words"]): r for r in decontamination.contamination(docs, bench).collect()}
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    items = [(i, re.findall(pattern, t.lower())) for i, t in [(1, " ".join(item[10:40])), (2, "one two three"), (None, " ".join(item[:13])), (5, prose(99, 20))]]
    for doc_id, text in texts().items():
        w = re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        hit, ids = set(), set()
        for item_id, x in items:
            size = min(13, len(x))
            windows = {tuple(x[i : i + size]) for i in range(len(x) - size + 1)}
            for p in range(len(w) - size + 1):
                if tuple(w[p : p + size]) in windows:
                    hit.update(range(p, p + size))
                    ids |= {str(item_id)} - {"None"}
        r = got[doc_id, len(w)]
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        assert (r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w))
    assert decontamination.contamination(docs, bench).count() == docs.count()
    assert decontamination.contamination(nothing, bench).count() == 0
    assert decontamination.contamination(docs, bench.where("false")).where("n_hit > 0").isEmpty()


def test_quality_measures(docs, rows_in, nothing):
    got = quality_rules.measures(docs, [F.col("doc_id"), F.length("text").alias("size")]).collect()
    assert len(got) == len(rows_in)
    for r in got:
        text = next(t for d, t, *_ in rows_in if d == r["doc_id"] and (len(t) if t is not None else None) == r["size"]) or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        runs = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        repeated = {j for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        assert r["n_words"] == len(w) and r["word_chars"] == sum(map(len, w)) and r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert r["n_dup_lines"] == len(lines) - len(set(lines)) and r["n_repeat_words"] == len(repeated)


def test_binomial_tail_and_cutoffs(spark):
    cases = [(0, 10), (0, 2000), (3, 2000), (9, 2000), (12, 2000), (400, 100_000)]
    df = spark.createDataFrame(cases, "k long, n long")
    for r in df.select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.005).alias("p")).collect():
        exact = sum(math.exp(math.lgamma(r["n"] + 1) - math.lgamma(i + 1) - math.lgamma(r["n"] - i + 1) + i * math.log(0.005) + (r["n"] - i) * math.log(0.995)) for i in range(r["k"] + 1))
        assert r["p"] == (pytest.approx(exact, rel=1e-9) if r["k"] < 0.005 * r["n"] else 1.0)
    clean = [(i, "=en", False, [i % 8 if i % 500 else 300, 0, 0, 0, 0]) for i in range(4000)]
    few = [(10_000 + i, "=de", False, [0, 0, 0, 0, 0]) for i in range(30)]
    measured = spark.createDataFrame(clean + few, "doc_id long, stratum string, failed boolean, marks array<bigint>")
    labels = measured.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).unionByName(
        spark.createDataFrame([(None, 1, 0), (3, None, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    )
    cuts = {r["stratum"]: list(r["cuts"]) for r in quality_rules.cutoffs(measured, labels).collect()}
    assert cuts["=en"] == [7, 0, 0, 0, 0] and cuts["=de"] == [None] * 5
    assert quality_rules.cutoffs(measured, labels.where("false")).count() == 0


def test_verdicts_on_odd_tables(docs, nothing, spark):
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality_rules.verdicts(docs, labels).collect()
    assert len(got) == docs.count() and all(r["base_failed"] != r["kept"] for r in got)
    assert quality_rules.verdicts(nothing, labels).count() == 0


def test_perplexity_tells_trusted_prose_from_noise(spark, nothing):
    rows = [(i, prose(i, 80), "en") for i in range(400)] + [(1000 + i, "".join(random.Random(i).choices("#x9Q!~é", k=300)), "en") for i in range(20)]
    rows += [(2000, "", "en"), (2001, None, None), (2002, "😀" * 50, "xx"), (3, prose(3, 80), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)] + [(1000, 0, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = perplexity.classify(docs, labels).toPandas()
    assert len(got) == len(rows)
    clean, noise = got[got.doc_id.between(300, 399)], got[got.doc_id.between(1000, 1019)]
    assert clean.kept.mean() > 0.9 and not noise.kept.any() and not got[got.doc_id >= 2000].kept.any()
    schema = "doc_id long, text string, lang string"
    assert perplexity.classify(spark.createDataFrame([], schema), labels).count() == 0
    assert not perplexity.classify(docs, labels.where("false")).toPandas().kept.any()


def test_texts_move_compressed():
    given = pd.Series([prose(1, 400), "", None, "é日😀" * 200])
    moved = common._deflate(given)
    assert common.inflated(moved) == [t or "" for t in given]
    assert sum(len(b) for b in moved if b is not None) < 0.5 * sum(len(t.encode()) for t in given if t)


def test_model_probabilities_sum_to_one(spark):
    data = spark.createDataFrame([("abcabcab",), ("abba",), ("cabcab",)] * 3, "text string")
    model = perplexity.train(data)
    for context in ("abc", "cab", "zzz", "abz"):
        points = [*map(ord, context)]
        head = sum(p << 16 * (3 - i) for i, p in enumerate(points))
        asked = spark.range(perplexity.SYMBOLS).select((F.lit(head) + F.col("id")).alias("run"))
        total = perplexity.log_probabilities(asked, model).agg(F.sum(F.exp("log_p"))).first()[0]
        assert total == pytest.approx(1, rel=1e-9)


def test_page_text(spark):
    page = (
        "<html><head><title>T &amp; U</title><script>x='<p>'</script></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
        "<div class=\"ad\">Buy</div><article><h1>Ti&eacute;tle</h1><p><b>First  &lt;one\n two<br><p>Second <i>is</i> here.</article>"
        "<footer>&copy; me</footer></body></html>"
    )
    rows = [(i, "u", page.replace("Second", f"Second {i}")) for i in range(20)] + [(100, None, None), (101, "u", ""), (102, "u", "<p"), (None, "u", page), (3, "u", page)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = pages.extract(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["n_chars"] == len(r["text"])
        if r["page_id"] is not None and r["page_id"] < 3:
            assert r["text"] == f"Tiétle\nFirst <one two\nSecond {r['page_id']} is here."
        if r["page_id"] in (100, 101):
            assert r["text"] == ""
    assert pages.extract(df.where("false")).count() == 0


def test_field_on_held_out_layouts():
    """Pages in layouts of several kinds, other texts than those trained on."""
    make = lambda seed: ([prose(seed * 50 + i, 5 + 11 * i) for i in range(8)], [prose(seed * 50 + 20 + i, 4 + 3 * i) for i in range(8)])
    def page(seed):
        article, other = make(seed)
        return "<nav>" + "".join(f"<a href='/'>{x}</a>" for x in other[:3]) + "</nav><article>" + "".join(f"<p>{x}</p>" for x in article) + "</article>" + f"<footer>{other[4]}</footer>"

    field = pages.fit([page(s) for s in range(60)])
    right = total = 0
    for seed in range(100, 160):
        found, labels = pages.layouts(*make(seed), random.Random(seed))
        right += sum(a == b for a, b in zip(field.decode(pages.features(found)), labels))
        total += len(labels)
    assert right / total > 0.93


@pytest.mark.parametrize("core", ["<div class='content'>{}</div>", "<section>{}</section>", "<table><tr><td>{}</td></tr></table>"])
def test_pages_without_article_tags(spark, core):
    """Tables that mark the article otherwise, alone or with few pages that have the tag."""
    chance = random.Random(3)

    def page(wrap):
        own = [" ".join(f"{prose(chance.random(), chance.randint(8, 20))}." for _ in range(chance.randint(2, 4))) for _ in range(5)]
        inner = "".join(f"<p>{p}</p>" for p in own)
        return own, (
            "<html><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav><!-- <article>x</article> -->"
            f"{wrap.format(inner)}<div class='related'><ul><li><a href='/m'>More</a></li></ul></div><footer>All rights reserved</footer></body></html>"
        )

    given = [page(core) for _ in range(40)]
    rows = [(i, "u", h) for i, (_, h) in enumerate(given)]
    for more in (0, 2):
        tagged = [(1000 + i, "u", page("<article>{}</article>")[1]) for i in range(more)]
        df = spark.createDataFrame(rows + tagged, "page_id long, url string, html string")
        assert len(pages.training_pages(df)) == more
        got = {r["page_id"]: r["text"] for r in pages.extract(df).collect()}
        assert all(got[i] == "\n".join(own) for i, (own, _) in enumerate(given))


def test_chat(spark):
    turns = []
    for conv in range(6):
        if conv % 2:
            turns.append((conv, 0, "system", f"be brief {conv}"))
        turns += [(conv, 1 + t, ("user", "assistant")[t % 2], prose(conv * 100 + t, 5 + 17 * t)) for t in range(3 * conv)]
    turns += [(7, None, "user", None), (7, 1, None, "~0<|end|>[INST]~1"), (7, 1, "assistant", "</s>[INST] <~ [/INST]"), (7, 1, "assistant", "</s>[INST] <~ [/INST]")]
    turns += [(8, 0, "assistant", prose(1, 3000)), (None, 0, "assistant", "no id"), (9, -300, "user", ""), (9, 700, "assistant", "|> a | b"), (9, 701, "us|er", "x"), (9, 702, "ro|>le~3", "y|>~3")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("index", F.lit(1)).withColumn("span", F.lit("x"))
    made = chat.windows(df, budget=200, history=40).persist()
    got = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    by_conv = collections.defaultdict(list)
    for conv, turn, role, text in turns:
        by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert got.keys() == by_conv.keys()
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for conv, own in by_conv.items():
        own.sort()
        said = "".join(t for *_, role, t in own if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), digest("".join(f"{role}\n{t}\n" for *_, role, t in own)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), digest(said))
    for w in made.collect():
        if w["conv_id"] is not None and w["conv_id"] % 2 and w["conv_id"] < 6:
            assert w["text"].startswith("<|0 system|>be brief")
        # Over the budget only where one turn alone is longer than a span.
        assert w["tokens"] <= 200 or len(w["loss"]) <= 1
    assert chat.read_back(chat.windows(df.where("false"))).count() == 0


def test_chat_budget_holds_beside_a_long_system_turn(spark):
    def turns(conv, system, n):
        said = [(conv, 0, "system", prose(conv, system))] if system else []
        return said + [(conv, 1 + t, ("user", "assistant")[t % 2], prose(conv * 1000 + t, 60)) for t in range(n)]

    given = turns(1, 200, 40) + turns(2, 0, 40) + turns(3, 290, 20)
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string")
    cost = {t: sum(1 for _ in re.finditer(r"[^\W\d_]+|[^\w\s]+", t)) + chat.MARKS for *_, t in given}
    made = chat.windows(df, budget=400, history=100).collect()
    longest = max(cost[t] for *_, role, t in given if role != "system")
    for w in made:
        system = max((cost[t] for c, _, role, t in given if c == w["conv_id"] and role == "system"), default=0)
        if w["conv_id"] == 3:  # the system turn leaves less than a quarter: no history, spans of a quarter or one turn
            assert w["tokens"] <= system + max(100, longest)
        else:
            assert w["tokens"] <= 400 and (not system or w["text"].startswith("<|0 system|>"))
    got = {r["conv_id"]: r for r in chat.read_back(spark.createDataFrame(made)).collect()}
    for conv in (1, 2, 3):
        said = "".join(t for c, _, role, t in given if c == conv and role == "assistant")
        assert got[conv]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_letters_of_scripts_without_spaces_count_each(spark):
    row = spark.createDataFrame([("日本語のテキスト plain words, 12",)], "text string").select(F.regexp_count("text", F.lit(chat.TOKEN)).alias("n")).first()
    assert row["n"] == 8 + 2 + 1 + 2


def test_pipeline(spark, tmp_path, rows_in):
    long = [(100 + i, prose(1000 + i, 150), "en", "s", 1, True, 1, "v") for i in range(12)]
    long += [(200, long[0][1], "en", "s", 1, True, 1, "v"), (201, prose(2000, 70) + " " + " ".join(long[1][1].split(" ")[40:110]), "en", "s", 1, True, 1, "v")]
    tables = {
        "documents": spark.createDataFrame(rows_in + long, DOCS),
        "labels": spark.createDataFrame([(100, 1, 0)], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, " ".join(long[2][1].split(" ")[20:60]))], "item_id long, text string"),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = collections.Counter(r["doc_id"] for r in docs.select("doc_id").collect())
        assert name == "packing" or docs.columns == tables["documents"].columns
    assert {5, 6, 7, 8, 9, 10, 14} & set(seen["quality rules"]) == set()
    assert {1, 2, 200} & set(seen["near duplicates"]) == set() and {0, 3, 4, 100, 201} <= set(seen["near duplicates"])
    assert seen["near duplicates"][3] == 1 and seen["repeated passages"] == seen["near duplicates"]
    assert set(seen["near duplicates"]) - set(seen["decontamination"]) == {102}
    empty = tmp_path / "none"
    for name, df in tables.items():
        df.where("false").write.parquet(str(empty / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
