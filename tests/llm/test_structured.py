"""License scans, whitening and conversation repair against brute force, and their defined cases."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from footfall.llm import licenses, structure, whitening

ROWS = "conv_id long, turn long, role string, text string, key string, place long"


def faults_of(rows):
    """Class and fault of each row of one conversation, in order, by the words of the contract."""
    seen, out = set(), []
    for _, role, text in rows:
        tail = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = "blank" if not tail else "duplicate" if (role, text) in seen else "truncated" if tail not in ".!?" else ""
        seen.add((role, text))
        out.append((role[:1], fault))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by the least (cost, audit) over all edit lists, from the end."""
    marked = faults_of(rows)
    turn = {"": "u", "s": "u", "u": "a", "a": "u"}
    legal = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    name = {"u": "user", "a": "assistant"}
    best = {("", len(rows)): (0, "", []), ("a", len(rows)): (0, "", [])}
    best["u", len(rows)] = (5, "I", [("assistant", "")])
    best["s", len(rows)] = (10, "II", [("user", ""), ("assistant", "")])
    for i in range(len(rows) - 1, -1, -1):
        role, text = rows[i][1:]
        start, fault = marked[i]
        for last in ("", "s", "u", "a"):
            def option(cost, letter, target, added):
                c, a, r = best[target, i + 1]
                return c + cost, letter + a, added + r

            found = [option(2, "D", last, [])]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if (last, start) in legal:
                    found.append(option(more, "K", start, [(role, text)]))
                found.append(option(1 + more, "R", turn[last], [(name[turn[last]], text)]))
            best[last, i] = min(found)
        for _ in range(2):
            old = {last: best[last, i] for last in turn}
            for last, target in turn.items():
                c, a, r = old[target]
                best[last, i] = min(best[last, i], (c + 5, "I" + a, [(name[target], ""), *r]))
    return best["", 0]


def repaired_by_hand(rows):
    """The contract's row for each conversation of damaged `rows` (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, f"{r[1]}:{r[2]}".encode()))
        marked = faults_of(own)
        turns = [t for t, _, _ in own if t is not None]
        cost, audit, kept = cheapest(own)
        count = [sum(f == kind for _, f in marked) for kind in ("blank", "duplicate", "truncated")]
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(marked))
        digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *count, illegal, cost, audit, digest)
    return out


def damaged_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def talk():
    chance = random.Random(5)
    rows = []
    for conv in range(60):
        for turn in range(chance.choice((1, 2, 3, 8, 8, 17, 40))):
            role = chance.choice(("user", "assistant", "user", "assistant", "system", "tool", "", None)) if chance.random() < 0.4 else ("user", "assistant")[turn % 2]
            text = chance.choice(("Yes.", "No!", "Why", "one two. ", "", " \t", None, f"Say {conv} {turn}.", f"{turn} é?", "l" * 70 + str(turn)))
            rows.append((conv, None if chance.random() < 0.05 else turn // chance.choice((1, 1, 2)), role, text))
    rows += [(None, t, r, "Hm.") for t, r in enumerate(("user", "assistant", None))] + [(100, t, "user", "same.") for t in range(30)] + [(101, 7, "user", "same.")] * 40
    return rows + [(-5, None, None, None), (102, 0, "system", "Rules.")]


@pytest.mark.parametrize("chunk", (2, 4, structure.CHUNK))
def test_repair(spark, chunk):
    rows = talk()
    given = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS).repartition(5)
    assert sorted(map(tuple, structure.damage(given).collect()), key=repr) == sorted(damaged_by_hand(rows), key=repr)
    for hurt, frame in ((damaged_by_hand(rows), structure.damage(given)), (rows, given)):
        expected = repaired_by_hand(hurt)
        found = {r[0]: tuple(r)[1:] for r in structure.report(frame, given, chunk).collect()}
        assert set(found) == {r[0] for r in rows}
        for conv, row in found.items():
            assert row == expected.get(conv, (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())), (conv, row, expected.get(conv))


def test_repaired_rows_keep_what_they_had(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "Again."), (1, 2, "user", "cut off"), (1, 3, "assistant", "End.")]
    summary, repaired = structure.repair(spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS))
    (line,) = summary.collect()
    assert (line["cost"], line["audit"]) == (3, "RKDD") or line["audit"] == cheapest([r[1:] for r in rows])[1]
    kept = [(r["role"], r["text"]) for r in repaired.orderBy("no", "at").collect()]
    assert kept == cheapest([r[1:] for r in rows])[2]


def test_no_conversations(spark):
    empty = spark.createDataFrame([], ROWS)
    assert structure.report(structure.damage(empty), empty).collect() == []


def test_long_conversation_is_cut_into_chunks(spark):
    rows = [(1, t, ("user", "assistant")[(t + t // 50) % 2], f"Turn {t}" + "."[: t % 7]) for t in range(3000)]
    found = structure.report(spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS).repartition(7), spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS), 64).collect()
    assert [tuple(r)[1:] for r in found] == [repaired_by_hand(rows)[1]]


# Whitening ----------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, n long, component string"


def whitened_by_hand(vectors, k):
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    apart = n * x - sums
    v = np.array([[sum(a * b) / n**3 for b in apart.T] for a in apart.T], dtype=float)
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e)[:k]
    return n, (apart**2).sum(axis=1), (apart.astype(float) / n) @ u[:, order] / np.sqrt(e[order]), e[order] / np.trace(v)


@pytest.mark.parametrize("scale", (1.0, 3e3))
def test_whitening(spark, scale):
    chance = np.random.default_rng(3)
    vectors = (chance.normal(size=(300, 6)) @ np.diag([3, 2, 1, 0.5, 0.3, 0.1]) * scale + 0.2).tolist()
    rows = [(i, v, 0, 1, "x") for i, v in enumerate(vectors)]
    odd = [(900, None, 0, 1, "x"), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0, 1, "x"), (902, [float("nan")] * 6, 0, 1, "x"), (903, [float("inf")] * 6, 0, 1, "x"), (904, [1.0] * 5, 0, 1, "x"), (905, [], 0, 1, "x")]
    twice = [*rows, (7, vectors[7], 0, 1, "x"), (None, vectors[8], 0, 1, "x")]
    n, deviation, white, explained = whitened_by_hand([*vectors, vectors[7], vectors[8]], 4)
    found = whitening.whiten(spark.createDataFrame([*twice, *odd], VECTORS).repartition(5), components=4).collect()
    assert len(found) == 4 * n
    for component in range(1, 5):
        own = sorted((r for r in found if r["component"] == component), key=lambda r: (r["vec_id"] is None, r["vec_id"], r["whitened"]))
        order = sorted(range(300), key=int)
        order = [*order[:7], 7, 7, *order[8:], 301]
        assert [r["deviation"] for r in own] == [int(deviation[i]) for i in order]
        given = np.array([r["whitened"] for r in own])
        expected = white[order, component - 1]
        sign = np.sign(given @ expected)
        assert np.abs(given * sign - expected).max() < 1e-7 * np.abs(expected).max() + 1e-9
        assert {r["n"] for r in own} == {n} and abs(own[0]["explained"] - explained[component - 1]) < 1e-9
    assert max(r["identity_error"] for r in found) < 1e-9


def test_scatter_counts_are_exact():
    chance = np.random.default_rng(4)
    y = chance.integers(0, 1 << 20, size=(1000, 5)).astype(np.uint64)
    counts = np.zeros((39, 5, 5), dtype=np.int64)
    whitening.add_products(counts, whitening.bit_planes(y, 20))
    exact = y.astype(object).T @ y.astype(object)
    assert (sum(counts[s].astype(object) * (1 << s) for s in range(39)) == exact).all()


def test_whitening_without_variance_and_with_huge_numbers(spark):
    same = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25], 0, 1, "x")] * 3, VECTORS)).collect()
    assert {(r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in same} == {(0.0, 0.0, 0, 0.0)}
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == []
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300, 0.0], 0, 1, "x"), (2, [-1e300, 1.0], 0, 1, "x"), (3, [0.0, 3.0], 0, 1, "x")], VECTORS)).collect()
    assert {r["deviation"] for r in huge if r["vec_id"] != 3} == {None} and max(r["identity_error"] for r in huge) < 1e-4


# Licenses ------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, label string, place int, words string"


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def scanned_by_hand(text, templates=licenses.TEMPLATES, k=licenses.K):
    w = license_words(text)
    starts, base = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split(" ")
        own = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        starts += own
        base |= {label} if own else set()
    labels, score = set(base), 0.0
    for label, template in templates:
        t = license_words(template)
        met = {}
        for i in range(len(w) - k + 1):
            for j in range(len(t) - k + 1):
                if w[i : i + k] == t[j : j + k]:
                    met.setdefault(i - j, set()).add(j)
        for centre in met:
            places = {j + o for d in range(centre - licenses.BAND, centre + licenses.BAND + 1) for j in met.get(d, ()) for o in range(k)}
            share = len(places) / len(t)
            score = max(score, share)
            if share >= licenses.COVERED and all(i in places for i, x in enumerate(t) if re.fullmatch("[0-9]+", x)):
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


def license_texts():
    mit = next(t for label, t in licenses.TEMPLATES if label == "mit" and len(t) > 100)
    worn = mit.replace("free of charge", "free of any charge").replace("Software without restriction", "Software")
    return [
        "Licensed under CC BY-NC 4.0.", "Released under the MIT License. Licensed under the Apache License, Version 2.0.", None, "", "...",
        "This work is licensed under the GNU General Public License, version 3.", "licensed under the gnu general public license version", mit, worn, mit.upper() + " é " + mit,
        "MIT-License mit license mit; license", "cc by", "cc-by cc by", "a mit licensed apache LICENSE", "na " * 400, " ".join(t for _, t in licenses.TEMPLATES),
        "Übung 日本 licensed under cc by sa 4 0", "x " * 20_000 + "Released under the MIT License", ("Released under the MIT License\n" * 300).strip(),
    ]


@pytest.mark.parametrize("bound", (licenses.BROADCAST_ROWS, 0))
def test_license_scan(spark, monkeypatch, bound):
    monkeypatch.setattr(licenses, "BROADCAST_ROWS", bound)
    rows = [(i, t, "en", "x", 1, "y") for i, t in enumerate(license_texts())] + [(1, "MIT License", "en", "x", 1, "y"), (0, license_texts()[0], "en", "x", 1, "y"), (None, "cc by", None, None, None, None)]
    found = licenses.scan(spark.createDataFrame(rows, DOCS).repartition(3)).drop("version").collect()
    expected = [(i, *scanned_by_hand(t)) for i, t, *_ in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_license_labels(spark):
    labels = {i: scanned_by_hand(t)[5] for i, t in enumerate(license_texts())}
    assert labels[0] == "cc-by,cc-by-nc-4.0" and labels[1] == "apache,apache-2.0,mit" and labels[5] == "gpl,gpl-3.0"
    assert labels[6] == "gpl" and labels[7] == "mit" and labels[8] == "mit" and labels[13] == "apache"


def test_license_scan_of_nothing(spark):
    assert licenses.scan(spark.createDataFrame([], DOCS)).collect() == []
    none = licenses.scan(spark.createDataFrame([(1, "MIT License", "en", "x", 1, "y")], DOCS), licenses.template_rows(spark, [])).collect()
    assert [(r["labels"], r["score"]) for r in none] == [("mit", 0.0)]
