"""Further brute-force versions, hot keys and odd input of the training-data operators."""

import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlake.llm import fingerprint, jaccard_join, katz, langid, licenses, mixing, secrets, substring_dedup, warc
from sessionlake.llm.common import Scratch

from test_operators import DOCS, accepted, brute_katz, frame, odd


# --- language ID ------------------------------------------------------------------------------


def gram_buckets(text):
    """Buckets of the 1-, 2- and 3-grams of a text, one after another."""
    low = lambda c: (c.lower()[0] if c.isalpha() else " ") if ord(c) < 0x20000 else c
    c = [ord(low(x)) for x in f" {text}  "]
    cut = lambda x: x & 0xFFFFFFFF
    for a, b, d in zip(c, c[1:], c[2:]):
        one = cut(a * 0x9E3779B1)
        two = cut(cut((one ^ one >> 13) * 0x85EBCA6B) + b * 0xC2B2AE35)
        three = cut(cut((two ^ two >> 15) * 0x27D4EB2F) + d * 0x165667B1)
        for g in (one, two, three):
            yield cut((g ^ g >> 16) * 0x7FEB352D) >> 17


def brute_language(train, texts):
    counts, docs = {}, Counter()
    for text, label in train:
        docs[label] += 1
        counts.setdefault(label, Counter()).update(gram_buckets(text))
    out = []
    for text in texts:
        joint = {}
        for label, own in counts.items():
            total = sum(own.values()) + 0.5 * langid.BUCKETS
            joint[label] = math.log(docs[label] / sum(docs.values())) + sum(math.log((own[g] + 0.5) / total) for g in gram_buckets(text))
        best = min(joint, key=lambda x: (-joint[x], x))
        heat = min(1.0, langid.EVIDENCE / (len(text) + 1))
        out.append((best, 1 / sum(math.exp((v - joint[best]) * heat) for v in joint.values())))
    return out


def language_rows(seed, n):
    rnd = random.Random(seed)
    syllables = {"aa": ["tho", "ing", "ea", "st"], "bb": ["que", "oi", "ment", "é"], "cc": ["sch", "ung", "ich", "ü", "ea"]}
    return [(i, " ".join("".join(rnd.choices(syllables[x], k=3)) for _ in range(rnd.randrange(1, 20))), x)
            for i, x in enumerate(rnd.choices(list(syllables), weights=[8, 2, 1], k=n))]


@pytest.mark.parametrize("cells", [langid.MAX_CELLS, 3 * 512])
def test_language_equals_a_dictionary_version(spark, cells, monkeypatch):
    rows = language_rows(4, 80)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "MAX_CELLS", cells)
    model = langid.train(df.where("doc_id < 50"))
    texts = [t for _, t, _ in rows[50:]] + ["x", "\U00020000 a", "ea"]
    got = langid.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    if cells < langid.BUCKETS:
        assert model.matrix.shape == (512, 3) and {r["lang_pred"] for r in got} <= {"aa", "bb", "cc"}
        return
    for r, (label, share) in zip(got, brute_language([(t, x) for _, t, x in rows[:50]], texts), strict=True):
        assert r["lang_pred"] == label and r["score"] == pytest.approx(share, rel=1e-3)


def test_language_of_odd_input_replaces_only_its_own_names(spark):
    model = langid.train(spark.createDataFrame(language_rows(5, 30), "doc_id long, text string, lang string"))
    got = langid.predict(odd(spark), model)
    assert got.columns.count("score") == 1 and got.count() == 6
    named = langid.predict(odd(spark), model, label="__lang", score="__sure")
    assert {r["score"] for r in named.collect()} == {"s"}
    assert langid.predict(odd(spark).where("false"), model).count() == 0


# --- fingerprints -----------------------------------------------------------------------------


def test_followers_of_outlying_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 4)
    ids = list(range(40)) + [2**61, -(2**61)] + [None] * 3
    rows = [(i, f"text {n} of {i} " * 3) for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__bucket", F.lit("mine"))
    placed = fingerprint.with_next(df.select("doc_id", "text"))
    assert max(r["count"] for r in placed.where("not __copy").groupBy("__bucket").count().collect()) <= 8
    got = {r["edited_sha256"] for r in fingerprint.edit_report(df).where("doc_id is not null").collect()}
    known = sorted((r for r in rows if r[0] is not None), reverse=True)
    first_null = {t for i, t in rows if i is None}
    for (i, a), follower in zip(known, [[t] for _, t in known[1:]] + [first_null], strict=True):
        half = len(a) // 2
        assert any(hashlib.sha256((a[: len(a) - half] + b[:half]).encode()).hexdigest() in got for b in follower), i
    assert fingerprint.bounds(df.where("false")) == []


# --- Jaccard join -----------------------------------------------------------------------------


def test_signatures_left_out_do_not_lose_links(spark, monkeypatch):
    """A passage that all documents share, and near copies of some of them."""
    monkeypatch.setattr(jaccard_join, "ROUNDS", 1)
    rnd = random.Random(21)
    shared = " ".join(f"c{i}" for i in range(40))
    texts = []
    for _ in range(30):
        own = [f"w{rnd.randrange(10**6)}" for _ in range(rnd.choice([15, 30, 60]))]
        texts.append(" ".join([shared, *own]))
        if rnd.random() < 0.5:
            own[rnd.randrange(len(own))] = "changed"
            texts.append(" ".join([shared, *own]))
    from test_operators import brute_components

    for measure in (jaccard_join.Measure(5, 80, 100), jaccard_join.Measure()):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join_components(frame(spark, texts).repartition(4), measure).collect()}
        assert got == brute_components(texts, measure.n, measure.num, measure.den)


def test_similar_sets_share_more_signatures_than_they_may_leave_out():
    rnd = np.random.default_rng(3)
    for m in (jaccard_join.Measure(), jaccard_join.Measure(5, 80, 100)):
        for size in (1, 3, 9, 14, 31, 77, 200, 700):
            for _ in range(15):
                a = np.unique(rnd.integers(0, 2**63, size).astype(np.uint64))
                gone = rnd.integers(0, (m.den - m.num) * len(a) // (2 * m.den) + 1)
                b = np.unique(np.concatenate((a[gone:], rnd.integers(0, 2**63, gone).astype(np.uint64))))
                common = len(np.intersect1d(a, b))
                if not len(b) or not m.linked(common, len(a), len(b)):
                    continue
                sa, sb = m.signatures(a), m.signatures(b)
                for parity, (x, y) in enumerate(zip(m.surplus(a), m.surplus(b), strict=True)):
                    both = np.intersect1d(sa[sa & np.uint64(1) == parity], sb[sb & np.uint64(1) == parity])
                    if len(both) > max(x, y):
                        break
                else:
                    raise AssertionError((m, size))


#: Two texts of similarity 12 / 15 whose sets have several weak parts.
WEAK = ["w10141 w31929 w33219 w8778 w15893 w22601 w15503 w22336 w15429 w13538 w14622 w13701 w16375 w23966 w22714",
        "w10141 w31929 w33219 w8778 w15893 w22601 w15429 w14622 w13701 w16375 w23966 w22714"]


def test_sets_with_weak_parts_keep_their_links(spark):
    got = jaccard_join.join_components(frame(spark, WEAK), jaccard_join.Measure(1, 80, 100)).collect()
    assert {r["component_id"] for r in got} == {0}


def test_small_sets_share_a_signature_that_both_keep():
    """All sizes from 2 to 30: whatever is left out, similar sets keep the rarest signature they share."""
    rnd = np.random.default_rng(12)
    tried = 0
    for m in (jaccard_join.Measure(1, 80, 100), jaccard_join.Measure(1, 90, 100)):
        for size in range(2, 31):
            for _ in range(120):
                a = np.unique(rnd.integers(0, 2**63, size).astype(np.uint64))
                gone, new = rnd.integers(0, size // 5 + 1), rnd.integers(0, size // 5 + 1)
                b = np.unique(np.concatenate((a[gone:], rnd.integers(0, 2**63, new).astype(np.uint64))))
                if not len(b) or not m.linked(len(np.intersect1d(a, b)), len(a), len(b)):
                    continue
                tried += 1
                sa, sb = m.signatures(a), m.signatures(b)
                kept = False
                for parity, (x, y) in enumerate(zip(m.surplus(a), m.surplus(b), strict=True)):
                    own, other = (np.unique(s[s & np.uint64(1) == parity]) for s in (sa, sb))
                    both = np.intersect1d(own, other)
                    # At worst the shared ones are the most frequent of either set.
                    kept |= len(both) > max(x, y)
                assert kept, (m, size)
    assert tried > 3000


def test_sets_of_a_batch_are_those_of_each_text():
    rnd = random.Random(3)
    texts = [None, b"", b"one", b"One two", b" a\tb  c "] + [" ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.randrange(1, 90))).encode() for _ in range(60)]
    for m in (jaccard_join.Measure(), jaccard_join.Measure(5, 80, 100)):
        elements, sizes = jaccard_join.shingle_sets(texts, m.n)
        each = [jaccard_join.shingle_sets([t], m.n)[0] for t in texts]
        assert sizes.tolist() == [len(x) for x in each] and (elements == np.concatenate(each)).all()
        for text, n in zip(texts, sizes, strict=True):
            w = (text or b"").lower().split()
            assert n == len({tuple(w[i : i + m.n]) for i in range(max(len(w) - m.n + 1, min(len(w), 1)))})
        signature, at, surplus = m.signed_sets(elements, sizes[sizes > 0])
        for i, one in enumerate(x for x in each if len(x)):
            assert sorted(signature[at == i]) == sorted(m.signatures(one)) and tuple(surplus[i]) == m.surplus(one)


def test_jaccard_rows_of_one_id_are_one_document(spark):
    rows = [(5, "a b c d"), (5, "p q r s"), (3, "a b c d"), (9, "p q r s"), (None, "a b c d"), (7, None)]
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in jaccard_join.join_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, None), (3, 3), (5, 3), (5, 3), (7, 7), (9, 3)]


def test_scratch_tables_are_deleted(spark, tmp_path):
    scratch = Scratch(spark)
    scratch.base = str(tmp_path / "s")
    table = scratch.table(spark.range(5))
    assert table.count() == 5 and len(list((tmp_path / "s").iterdir())) == 1
    scratch.drop(table, None)
    assert not list((tmp_path / "s").glob("*[!c]"))


# --- secrets ----------------------------------------------------------------------------------


def test_markov_models_spare_ordinary_tokens_with_digits(spark):
    rnd = random.Random(10)
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    secret = lambda n=32: "".join(rnd.choice(letters) for _ in range(n))
    plain = lambda: rnd.choice([digits(16), f"report_{digits(4)}_summary_final", f"2024-{digits(2)}-{digits(2)}-backup-daily", f"docs/guide/version-{digits(1)}/index"])
    df = frame(spark, [f"token={secret(40)} then {plain()} and {plain()} in {plain()}" for _ in range(120)])
    ratios = secrets.train(secrets.samples(df))
    run = lambda texts: [r["spans"] for r in secrets.scan(frame(spark, texts), ratios).orderBy("doc_id").collect()]
    assert sum("markov" in s for s in run([secret() for _ in range(50)])) >= 48
    assert sum("markov" in s for s in run([plain() for _ in range(50)])) <= 2


# --- substring dedup --------------------------------------------------------------------------


def test_substring_dedup_of_odd_input(spark):
    long = "one two three four five six seven eight nine. " * 3_000
    rows = [(None, long), (1, long), (1, long), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"digest": F.lit("x"), "row": F.lit(1), "spans": F.lit(2), "n": F.lit(3)})
    got = substring_dedup.repeated_units(df).collect()
    assert {(r["first_doc_id"], r["first_start"]) for r in got} == {(1, 0)} and not any(r["doc_id"] == 1 and r["start"] == 0 for r in got)
    assert sum(r["doc_id"] is None for r in got) == 3_000 and sum(r["doc_id"] == 1 for r in got) == 2 * 2_999
    assert substring_dedup.repeated_units(df.where("false")).count() == 0
    assert substring_dedup.without_repeats(df).count() == 5


# --- language model ---------------------------------------------------------------------------


def test_katz_with_a_very_frequent_pair(spark, monkeypatch):
    """'x y' fills a third of the tokens and more; pairs, words, starts and ends are split."""
    rnd = random.Random(14)
    docs = [(i, "x y " * rnd.randrange(1, 12) + " ".join(rnd.choices("a b c d e".split(), k=rnd.randrange(0, 8))), i % 7 != 2) for i in range(70)]
    want, total = brute_katz(docs)
    assert total == pytest.approx(1.0)
    for hot, bucket in ((30, 80), (150, 300)):
        monkeypatch.setattr(katz, "HOT", hot)
        monkeypatch.setattr(katz, "BUCKET_TOKENS", bucket)
        got = {r["doc_id"]: r for r in katz.score(spark.createDataFrame(docs, "doc_id long, text string, train boolean").repartition(3)).collect()}
        assert set(got) == set(want)
        for d, (n, known, tokens, base, score) in want.items():
            r = got[d]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, tokens)
            assert (r["base_score"], r["score"]) == (pytest.approx(base, abs=1e-5), pytest.approx(score, abs=1e-5))


def test_katz_of_odd_input_gives_a_row_for_each_row(spark):
    got = katz.score(odd(spark).withColumn("train", F.lit(True)).withColumn("bucket", F.lit(1))).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got) == [(1, 1), (2, 1), (3, 3), (3, 3), (4, 30_001), (5, 4)]
    assert len({r["score"] for r in got if r["doc_id"] == 3}) == 1 and all(r["score"] < 0 for r in got)


# --- licences ---------------------------------------------------------------------------------


def brute_resolve(found):
    """Detections that lie in none of a better priority, nor in a longer one of the same, nor in a kept equal span."""
    kept = []
    for level in sorted({d.priority for d in found}):
        own = [d for d in found if d.priority == level]
        own = [d for d in own if not any(k.start <= d.start and d.end <= k.end for k in kept)]
        kept += [d for d in own if not any(
            o.start <= d.start and d.end <= o.end and (o.start, o.end) != (d.start, d.end) for o in found if o.priority == level)]
    return kept


def test_license_suppression_equals_brute_force():
    rnd = random.Random(17)
    for _ in range(400):
        found = []
        for _ in range(rnd.randrange(0, 9)):
            start = rnd.randrange(0, 12)
            found.append(licenses.Detection(rnd.randrange(1, 4), rnd.choice("abc"), start, start + rnd.randrange(1, 8), 0.5))
        got = licenses.resolve(found)
        assert sorted(map(str, got)) == sorted(map(str, brute_resolve(found))), found


def test_every_license_rule_finds_what_it_accepts():
    rnd = random.Random(18)
    labels = set()
    for rule in licenses.rules():
        tree = __import__("re")._parser.parse(rule.pattern.pattern.decode())
        line = f" {accepted(tree, rnd)} ".encode()
        found = licenses.detect(line)
        assert found and max(d.end for d in found) >= len(line.strip()) // 2, (rule, line)
        labels |= {d.label for d in found}
    assert len(labels) > 80


def test_licenses_replace_columns_of_the_same_name(spark):
    got = licenses.scan(odd(spark).withColumn("labels", F.lit("mine")))
    assert got.columns.count("score") == 1 and got.columns.count("labels") == 1 and got.count() == 6
    assert licenses.scan(odd(spark).where("false")).count() == 0


# --- mixing -----------------------------------------------------------------------------------


def test_mixing_with_zero_weights_and_growing_slices(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_DOCS", 4)
    rnd = random.Random(11)
    rows = [(i, " ".join(["x"] * rnd.randrange(0, 9)), rnd.choice(["en", "fr"]), rnd.choice(["src0", "src1", "src2"]), 0) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS)
    chosen = mixing.mix(docs, {"domain": {"domain0": 0}, "lang": {"en": 3}}).collect()
    size = {r[0]: len(r[1].split()) for r in rows}
    assert {r["domain"] for r in chosen} == {"domain1", "domain2"}
    spent = sum(r["n_tokens"] * r["copies"] for r in chosen)
    assert sum(size.values()) // 2 - 9 * 6 <= spent <= sum(size.values()) // 2
    plan = {(r["domain"], r["lang"], r["source"]): r for r in mixing.budgets(spark.createDataFrame(
        [(f"domain{s[-1]}", x, s, sum(size[r[0]] for r in rows if r[2] == x and r[3] == s)) for x in ("en", "fr") for s in ("src0", "src1", "src2")],
        "domain string, lang string, source string, tokens long"), {"domain": {"domain0": 0}, "lang": {"en": 3}}).collect()}
    for (domain, lang, source), p in plan.items():
        leaf = [r for r in rows if r[2] == lang and r[3] == source]
        full, rest = divmod(p["take"], p["tokens"])
        order = sorted((hashlib.md5(f"mix-1:{full + 1}:{r[0]}".encode()).hexdigest(), size[r[0]], r[0]) for r in leaf)
        want, total = {}, 0
        for _, n, d in order:
            total += n
            if full + (total <= rest):
                want[d] = full + (total <= rest)
        assert {r["doc_id"]: r["copies"] for r in chosen if (r["lang"], r["source"]) == (lang, source)} == want
    nothing = mixing.mix(docs, {"domain": {f"domain{i}": 0 for i in range(3)}})
    assert nothing.count() == 0


def test_mixing_of_odd_input_keeps_columns(spark):
    got = mixing.mix(odd(spark).withColumns({"copies": F.lit("mine"), "n_tokens": F.lit("mine")}))
    assert got.columns.count("copies") == 1 and dict(got.dtypes)["copies"] == "bigint" and dict(got.dtypes)["score"] == "string"
    assert {r["copies"] for r in got.where("doc_id = 3").collect()} in ({1}, {2}, set())


# --- WARC -------------------------------------------------------------------------------------


@pytest.mark.parametrize("broadcast", [warc.BROADCAST_ROWS, -1])
def test_warc_of_odd_pages(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(warc, "FILE_BYTES", 64 << 10)
    monkeypatch.setattr(warc, "READ_BYTES", 1 << 16)
    long = "y" * 5_000_000
    rows = [(i, f"http://h/{i}", "same") for i in range(30)] + [(40, None, long), (41, "u\r\nv", long), (7, "x", "other"), (7, "x", "other"), (None, "n", "same"), (None, None, None), (50, "e", "")]
    rows += [(100 + i, "m", str(i) * 20_000) for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "bytes": F.lit("b"), "original": F.lit(0), "kind": F.lit("k")}).repartition(3)
    got = warc.archive(pages, str(tmp_path / "w")).collect()
    assert len(got) == len(rows)
    assert Counter(r["page_id"] for r in got) == Counter(r[0] for r in rows)
    top = {}
    for i, _, h in rows:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    for r in got:
        of = [h or "" for i, _, h in rows if i == r["page_id"] and base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() == r["payload_digest"]]
        best = top[of[0]]
        same = best == (-1 if r["page_id"] is None else r["page_id"])
        assert (r["record_type"], r["refers_to"]) == (("response", None) if same else ("revisit", best)), r
        assert r["payload_bytes"] == len(of[0].encode()) and r["payload"] == (of[0].encode() if same else None)
    import gzip

    sizes = [len(gzip.decompress(f.read_bytes())) for f in (tmp_path / "w").rglob("*.gz")]
    assert max(sizes) < 5_002_000 and sum(n > 200_000 for n in sizes) == 1


# --- pipeline ---------------------------------------------------------------------------------


def test_pipeline_of_odd_documents(spark, tmp_path):
    import corpus_pipeline as pipeline

    text = "the quick brown fox jumps over the lazy dog and runs far away"
    rows = [(1, None, None, None, None), (2, "", "en", "s1", 0), (3, text, "en", "s1", 1), (3, text, "en", "s1", 1), (None, text + " again", "en", "s2", 1),
            (4, text, "en", "s2", 1), (5, "entirely other words stand in this text here " * 3_000, "en", "s1", 1), (6, "1234 5678", "en", "s1", 1)]
    df = spark.createDataFrame(rows, DOCS).withColumns({"score": F.lit("own"), "lang_pred": F.lit("mine"), "component_id": F.lit(7), "class": F.lit("c")})
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, "unrelated benchmark item of more than ten words in all, so to say")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
    kept = docs.select("doc_id", "score", "lang_pred", "component_id", "class").collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 3, 3, 5] and {tuple(r)[1:] for r in kept} == {("own", "mine", 7, "c")}
    out = pipeline.mixture(spark, docs, str(tmp_path))
    assert set(df.columns) <= set(out.columns)
    assert pipeline.language(spark, df.where("false"), str(tmp_path)).count() == 0
    empty = df.where("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
