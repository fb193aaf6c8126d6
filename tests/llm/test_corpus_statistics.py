"""Fingerprints, collocations and source divergence against brute force."""

import hashlib
import re
import tracemalloc
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pytest

from wattloom.llm import collocations, divergence, i_match

SCHEMA = ("doc_id long, text string, lang string, source string, id long, tie string, "
          "n long, phrase string, term string")


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(k, t, lang, source, 1, "x", 2, "y", "z") for k, t, lang, source in rows], SCHEMA)


def words(rng, n, names):
    return " ".join(str(w) for w in rng.choice(names, n))


# --- fingerprints --------------------------------------------------------------------

VOCABULARY = [f"word{a}{b}" for a in "abcdefgh" for b in "ijklmnopqr"]


@pytest.fixture(scope="module")
def fingerprinted(spark):
    rng = np.random.default_rng(2)
    texts = [words(rng, 60, VOCABULARY) for _ in range(40)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    rows += [(50, texts[0], "en", "s"), (51, " ".join(texts[1].split()[::-1]).upper(), "en", "s"),
             (60, None, "en", "s"), (61, "", None, None), (62, "... !!! \U0001F600é", "en", "s"),
             (63, "?", "en", "s"), (64, "one", "en", "s"), (65, "one two", "en", "s"),
             (66, words(rng, 60_000, VOCABULARY), "en", "s"), (None, "no id", "en", "s"),
             (7, texts[9], "en", "s"), (8, texts[8], "en", "s"), (8, texts[8], "en", "s")]
    return rows, i_match.compare(frame(spark, rows), idf_min=0.1, idf_max=4.0).collect()


def shape(name):
    full, base, slots = name.split(":")
    return full, int(base), [slots[i:i + 8] for i in range(0, len(slots), 8)]


def alike(a, b):
    (fa, ea, sa), (fb, eb, sb) = shape(a), shape(b)
    if fa == fb:
        return 1.0
    def at(base, slots):
        return {(base + k // i_match.SEEDS, k % i_match.SEEDS): h for k, h in enumerate(slots)}
    x, y = at(ea, sa), at(eb, sb)
    common = [(x[k], y[k]) for k in x.keys() & y.keys() if (x[k], y[k]) != ("0" * 8, "0" * 8)]
    return sum(p == q for p, q in common) / len(common) if common else 0.0


def test_fingerprints_and_edits(fingerprinted):
    rows, got = fingerprinted
    assert len(got) == len(rows)
    texts = defaultdict(set)
    for key, text, *_ in rows:
        texts[key].add(text or "")
    by_text = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.near_edited == pytest.approx(alike(r.fingerprint, r.edited_fingerprint))
        match = [t for t in texts[r.doc_id] if len(t) == r.n_chars]
        assert match
        if len(texts[r.doc_id]) == 1:
            assert by_text.setdefault(match[0], r.fingerprint) == r.fingerprint
    names = {r.doc_id: r for r in got}
    assert names[0].fingerprint == names[50].fingerprint
    assert names[51].fingerprint == names[1].fingerprint  # the same set of terms
    assert len({names[k].fingerprint for k in (60, 62, 63, 64, 65)}) == 5
    assert names[60].near_edited == 1.0 and names[60].near_next == 1.0  # both are empty
    assert names[62].near_next == 0.0 and names[64].near_edited == 1.0
    long = [r for r in got if r.doc_id is not None and r.doc_id < 40 and r.doc_id not in (7, 8)]
    assert np.mean([r.near_edited for r in long]) > 1.8 * np.mean([r.near_next for r in long])


def test_edits_take_the_next_document(fingerprinted):
    rows, got = fingerprinted
    once = Counter(k for k, *_ in rows)
    ordered = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    edited = {r.doc_id: r.edited_sha256 for r in got}
    for (k, t, *_), (k2, t2, *_) in pairwise(ordered):
        if once[k] == once[k2] == 1:
            t, t2 = t or "", t2 or ""
            q = len(t) // 4
            want = hashlib.sha256((t[:len(t) - q] + t2[:q]).encode()).hexdigest()
            assert edited[k] == want
    last, first = ordered[-1], next(r for r in rows if r[0] is None)
    q = len(last[1]) // 4
    assert edited[last[0]] == hashlib.sha256(
        (last[1][:len(last[1]) - q] + first[1][:q]).encode()).hexdigest()


def test_fingerprints_of_empty_and_single_tables(spark):
    assert i_match.compare(frame(spark, [])).collect() == []
    row = i_match.compare(frame(spark, [(1, "abcdefgh", "en", "s")])).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1.0


# --- collocations -----------------------------------------------------------------------

def brute_collocations(rows, least, top, cover=80):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        text = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", text):
            w = re.findall(r"[^ \t]+", piece)
            total[lang] += len(w)
            for d in range(1, 5):
                counts[lang].update(" ".join(w[i:i + d]) for i in range(len(w) - d + 1))
    out = []
    for lang, f in counts.items():
        often = {p: n for p, n in f.items() if n >= least}
        inside = Counter()
        for p, n in often.items():
            w = p.split(" ")
            for m in range(2, len(w)):
                for i in range(len(w) - m + 1):
                    part = " ".join(w[i:i + m])
                    inside[part] = max(inside[part], n)
        listed = []
        for p, a in often.items():
            w = p.split(" ")
            if len(w) < 2 or 100 * inside[p] >= cover * a:
                continue
            score, k = min((2000000 * a // (f[" ".join(w[:k])] + f[" ".join(w[k:])]), k)
                           for k in range(1, len(w)))
            listed.append((-score, -a, p.encode(), p, a, f[" ".join(w[:k])], f[" ".join(w[k:])]))
        for rank, (score, _, _, p, a, left, r) in enumerate(sorted(listed)[:top], 1):
            out.append((lang, rank, p, a, left, r, total[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("shard_words", [7, 1_000_000])
def test_collocations(spark, shard_words):
    rng = np.random.default_rng(4)
    names = ["a", "b", "B", "c", "é", "É", "d\x1c", "x.y", "\t", "\n", "\x0b", "z!", ",", "the"]
    rows = [(i, words(rng, int(rng.integers(0, 60)), names), str(rng.choice(["en", "fr"])), "s")
            for i in range(60)]
    rows += [(100, None, "en", "s"), (101, "", "en", "s"), (102, "a b a b a b a b", None, "s"),
             (102, "a b a b a b a b", None, "s"), (103, "a b c the", "und", "s"),
             (104, words(rng, 5000, names), "en", "s"), (None, ". . \t \n", "xx", "s")]
    got = collocations.collocations(frame(spark, rows), top=25, least=3, shard_words=shard_words)
    keep = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.select(keep).collect())) == brute_collocations(rows, 3, 25)


def test_collocations_of_empty_tables(spark):
    assert collocations.collocations(frame(spark, [])).collect() == []
    assert collocations.collocations(frame(spark, [(1, "a b", None, None)])).collect() == []


def test_index_intervals_give_all_counts():
    ids = np.array([0, 1, 2, 1, 2, 3, 0, 2, 1, 2, 1, 1, 0], np.int32)
    index = collocations.FmIndex(ids, 4)
    pairs = index.extend(index.single(), left=True, further=True)
    triples = index.extend(pairs, left=False, further=True)
    for found, size in ((pairs, 2), (triples, 3), (index.extend(triples, True, False), 4)):
        want = Counter(tuple(map(int, ids[i:i + size])) for i in range(len(ids) - size + 1)
                       if 0 not in ids[i:i + size])
        assert {tuple(map(int, w)): int(n)
                for w, n in zip(found.words, found.count, strict=True)} == want


# --- divergence -----------------------------------------------------------------------------

def brute_audit(rows, min_df, top):
    docs = [(lang or "", source or "", re.findall(
        r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = sorted(t for t, n in df.items() if n >= min_df)
        sources = sorted({d[1] for d in docs if d[0] == lang})
        n = {s: Counter(t for d in docs if d[:2] == (lang, s) for t in d[2] if t in set(kept))
             for s in sources}
        whole = sum(n.values(), Counter())

        def shares(c):
            total = sum(c.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}

        def far(p, q):
            return (p - q) * (p - q) // (p + q)
        p, q = {s: shares(n[s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [(-sum(far(p[s][t], p[o][t]) for t in kept), o.encode(), o)
                     for o in sources if o != s]
            terms = [(-far(p[s][t], q[t]), t.encode(), t) for t in kept
                     if n[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -value, rank)
                        for rank, (value, _, item) in enumerate(items, 1)]
    return sorted(out)


@pytest.mark.parametrize("most_terms", [1_000_000, 1])
def test_divergence(spark, most_terms):
    rng = np.random.default_rng(6)
    names = ["a", "B", "b", "É", "é", "x1y", "日本", "_", "c-d", "Z"]
    rows = [(i, words(rng, int(rng.integers(0, 30)), names), str(rng.choice(["en", "fr"])),
             str(rng.choice(["s1", "s2", "S2", "ü"]))) for i in range(60)]
    rows += [(100, None, "en", "silent"), (101, "", "fr", None), (102, "123 ...", None, "s1"),
             (103, "only here", None, "s2"), (103, "only here", None, "s2"), (None, "a a", "en", "s1"),
             (104, words(rng, 4000, names), "en", "s1"), (105, "lonely", "de", "one")]
    got = divergence.audit(frame(spark, rows), min_df=3, top=4, most_terms=most_terms)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, 3, 4)


def test_vectors_are_summed_per_source_before_they_are_exploded(spark):
    rows = [(i, "Ab a é  ab1 " * (i % 3), "en" if i % 2 else "", "s") for i in range(300)]
    got = divergence.tokens(frame(spark, rows).select("lang", "source", "text").coalesce(1), True)
    assert {(r.lang, r.source): Counter(r.terms) for r in got.collect()} == {
        (lang, "s"): {f"{lang}\0{t}": n for t, n in (("ab", 300), ("a", 150), ("é", 150))}
        for lang in ("en", "")} and got.count() == 2


def test_divergence_of_an_empty_table(spark):
    assert divergence.audit(frame(spark, [])).collect() == []


def test_extension_takes_few_bytes_a_word():
    ids = np.concatenate([[0], np.random.default_rng(5).zipf(1.3, 200_000) % 3000, [0]])
    index = collocations.FmIndex(ids.astype(np.int32), 3000)
    single = index.single()
    single = single.where(single.count >= 30)
    tracemalloc.start()
    index.extend(single, True, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 42 * len(ids)
