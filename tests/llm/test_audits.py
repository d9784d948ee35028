"""Filter audit, suffix dedup and Merkle manifest against brute-force versions and odd input."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import permutations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlake.llm import filter_audit, merkle, midstate, suffix_dedup
from sessionlake.llm.common import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    """Rows (doc_id, text, lang), with further columns of clashing names."""
    df = spark.createDataFrame([(i, t, lang, "src", len(t or "")) for i, t, lang in rows], DOCS).repartition(3)
    return df.withColumns({"part": F.lit(1), "mask": F.lit("x"), "tree": F.lit(2), "idx": F.lit("y"), "id": F.lit(0), "digest": F.lit(3), "gram": F.lit(4)})


# --- filter audit -------------------------------------------------------------------------


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, t, lang in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)}
        docs.append((lang or "", {f for f, bad in fails.items() if bad}, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        total = defaultdict(int)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in d[1] and bool(d[1] & set(order[: step - 1])) for d in own),
                                                   sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone), f]
        for (p, o, s), v in out.items():
            if p == part:
                v[6] = total[v[6]]
    return {k: tuple(v) for k, v in out.items()}


def test_audit_equals_brute_force(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(60):
        words = [rnd.choice(["a", "Bc", "d#", "XYZ", "e", f"w{rnd.randrange(400)}"]) if rnd.random() < 0.6 else f"u{rnd.randrange(9999)}" for _ in range(rnd.choice([3, 90, 120, 300]))]
        rows.append((rnd.choice([i, i, 7, None]), rnd.choice([" ".join(words), " ".join(words), "same text", "", None]), rnd.choice(["en", "de", "", None])))
    rows += [rows[5], (1, "word " * 20_000, "en"), (2, "word " * 20_000, "en"), (3, "ÄÖ    x", "en")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in [*range(40), 7, 7, None]]
    got = filter_audit.audit(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got.collect()} == brute_audit(rows, labels)
    assert got.count() == len({lang or "" for _, _, lang in rows}) * 600


def test_lattice_counts_paths():
    edges = filter_audit.lattice(4)
    assert len(edges) == 32
    for subset, f, orders in edges:
        k = subset.bit_count()
        assert not subset >> f & 1 and orders == factorial(k) * factorial(3 - k)


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(frame(spark, []), labels).count() == 0
    one = filter_audit.audit(frame(spark, [(None, None, None)]), labels).collect()
    assert len(one) == 600 and {r.part for r in one} == {""} and all(r.removed == (r.filter_order[r.step - 1] == "A") for r in one)


# --- Merkle manifest ----------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def leaf_of(i, source, lang, n, text):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (i, source, lang, n, text)))


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def fold(levels, at, digest):
    seen = ""
    for level in levels[:-1]:
        run = level[at // 8 * 8 : at // 8 * 8 + 8]
        seen += "".join(run[: at % 8] + run[at % 8 + 1 :])
        run[at % 8] = digest
        digest, at = sha("".join(run)), at // 8
    return digest, seen


def brute_manifest(rows):
    trees = defaultdict(list)
    for i, t, lang in rows:
        low = None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        own = leaf_of(i, "src", lang, len(t or ""), t)
        crc = zlib.crc32(("" if i is None else str(i)).encode()) % 3
        trees[lang].append((i is not None, i or 0, own, i, leaf_of(i, "src", lang, len(t or ""), low) if crc == 0 else own))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    grown = {x: climb([r[2] for r in sorted(trees[x])]) for x in names}
    top = climb([grown[x][-1][0] for x in names])
    out = []
    for k, x in enumerate(names):
        for at, (_, _, own, i, changed) in enumerate(sorted(trees[x])):
            digest, seen = fold(grown[x], at, changed)
            digest, more = fold(top, k, digest)
            out.append((i, own, grown[x][-1][0], top[-1][0], sha(seen + more), digest, digest == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, None: 1}, {"en": 9, "de": 65, "": 2, None: 70}, {f"l{k}": k % 4 + 1 for k in range(70)}])
def test_manifest_equals_brute_force(spark, sizes):
    rows = [(i, t, lang) for lang, n in sizes.items() for i, t in ((rnd_id(i), f"Text {i} ÄB" if i % 7 else None) for i in range(n))]
    got = merkle.audit(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_manifest(rows)


def rnd_id(i):
    return None if i % 13 == 5 else i // 2 * 3


def test_manifest_of_nothing(spark):
    assert merkle.audit(frame(spark, [])).count() == 0


def test_manifest_keeps_states_before_each_slot(spark):
    rows = [(i, f"t{i}", "en") for i in range(20)]
    nodes = merkle.Manifest(frame(spark, rows)).nodes().where("tree = '=en' and level = 1").orderBy("idx").collect()
    assert [len(r.children) // 32 for r in nodes] == [8, 8, 4]
    for r in nodes:
        kids = [r.children[k : k + 32].hex() for k in range(0, len(r.children), 32)]
        assert r.digest.hex() == sha("".join(kids))
        for k in range(len(kids)):
            # The state before a slot, resumed with that slot and those to its right, gives the digest again.
            state = midstate.to_state(np.frombuffer(r.before[32 * k : 32 * k + 32], np.uint8)[None, :])
            for kid in kids[k:]:
                state = midstate.compress(state, midstate.hex_block(np.frombuffer(bytes.fromhex(kid), np.uint8)[None, :]))
            assert midstate.finish(state, np.array([len(kids)]))[0].tobytes() == r.digest


# --- suffix dedup -------------------------------------------------------------------------


def brute_spans(texts):
    at = defaultdict(list)
    for i, t in enumerate(texts):
        for p in range(len(t) - 399):
            at[t[p : p + 400]].append((i, p))
    gone = [set() for _ in texts]
    for places in at.values():
        if len(places) > 1:
            for i, p in places:
                gone[i].update(range(p, p + 400))
    return gone


def edited_copies(rnd, n):
    base = ["".join(rnd.choice("abcdefgh \nÄ€") for _ in range(rnd.choice([120, 399, 400, 450, 900, 2500]))) for _ in range(5)]
    texts = list(base)
    for _ in range(n):
        t = rnd.choice(base)
        for _ in range(rnd.choice([0, 1, 2, 3])):
            p = rnd.randrange(len(t))
            t = t[:p] + rnd.choice(["", "X", "YZ"]) + t[p + rnd.choice([0, 1, 3]) :]
        if rnd.random() < 0.5:
            u = rnd.choice(base)
            t = t[: rnd.randrange(len(t))] + u[rnd.randrange(len(u)) :]
        texts.append(t)
    return [*texts, "ab" * 700, "a" * 401, "a" * 400, "xyz" * 300 + "q" + "xyz" * 300, "", "x" * 399]


@pytest.mark.parametrize("shard", [suffix_dedup.SHARD, 2])
def test_suffix_dedup_equals_brute_force(spark, shard, monkeypatch):
    monkeypatch.setattr(suffix_dedup.changed_texts, "__defaults__", (shard,))
    rnd = random.Random(shard)
    texts = [*edited_copies(rnd, 24), None]
    rows = [(rnd.choice([i, 3, None]), t, "en") for i, t in enumerate(texts)]
    got = suffix_dedup.report(frame(spark, rows)).collect()
    plain = [(t or "").encode() for t in texts]
    want = []
    for (i, _, _), t, gone in zip(rows, plain, brute_spans(plain), strict=True):
        runs = sum(p - 1 not in gone for p in gone)
        want.append((i, len(t), len(gone), runs, hashlib.sha256(bytes(b for p, b in enumerate(t) if p not in gone)).hexdigest()))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert sum(w[2] for w in want) > 10_000


def test_no_join_of_suffix_dedup_is_a_broadcast(spark, monkeypatch):
    table, plans = Scratch.table, []

    def noted(scratch, df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return table(scratch, df)

    monkeypatch.setattr(Scratch, "table", noted)
    monkeypatch.setattr(suffix_dedup.changed_texts, "__defaults__", (2,))  # shards are counted by hash too
    docs = frame(spark, [(i, t, "en") for i, t in enumerate(edited_copies(random.Random(5), 12))])
    for out in suffix_dedup.report(docs), suffix_dedup.without_repeats(docs):
        plans.append(out._jdf.queryExecution().executedPlan().toString())
    joins = "".join(plans)
    assert "SortMergeJoin [gram" in joins and ", back" in joins and "Broadcast" not in joins


def test_long_texts_are_cut_in_pieces(monkeypatch):
    rnd = random.Random(9)
    texts = [bytes(rnd.choice(b"abcd") for _ in range(n)) for n in (5000, 400, 399, 1200, 0)]
    whole = [x.tolist() for x in suffix_dedup.anchors_of(texts)]
    monkeypatch.setattr(suffix_dedup, "_PIECE", 450)
    assert [x.tolist() for x in suffix_dedup.anchors_of(texts)] == whole


def test_suffix_dedup_of_nothing(spark):
    assert suffix_dedup.report(frame(spark, [])).count() == 0
    assert [tuple(r)[1:4] for r in suffix_dedup.report(frame(spark, [(None, None, None)])).collect()] == [(0, 0, 0)]


def test_texts_without_repeats(spark):
    rnd = random.Random(4)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(500))
    rows = [(1, "one " + passage + " more", "en"), (2, "Two" + passage, "en"), (3, "clean", "en"), (4, None, "en")]
    got = {r.doc_id: (r.text, r.bytes) for r in suffix_dedup.without_repeats(frame(spark, rows)).collect()}
    assert got == {1: ("one  more", b"one  more"), 2: ("Two", b"Two"), 3: ("clean", b"clean"), 4: (None, b"")}


def test_distinct_texts_are_kept_once(spark):
    scratch = Scratch(spark)
    docs = frame(spark, [(i, "long enough " * 40, "en") for i in range(5)])
    assert [(r.copies, len(r.text)) for r in scratch.table(suffix_dedup.distinct_texts(docs)).collect()] == [(5, 480)]
