"""Learned rank index, source divergence and suffix family, each against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollwright.llm import fill_middle, source_divergence, suffix_family

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, copy string, rank_index string, n string"
ODD = [
    None, "", "\n", "\n\n\n", "one", "one\n", "é\n中文\r\n x\n", "a<P>b\nc", "x<S\n<S>", "<M>", "a\0b\n", "<\n>\n<P\n", "word " * 5000, "l\n" * 3000,
]


def table(spark, rows):
    """Rows of id, text, language and source, with further columns of clashing names."""
    return spark.createDataFrame([(i, t, lang, source, 0, "x", "x", "x", "x") for i, t, lang, source in rows], SCHEMA)


# -- learned rank index -----------------------------------------------------------------------------


def test_segments_keep_within_their_error():
    draw = random.Random(2)
    for lengths in ([draw.randrange(1, 400) for _ in range(5000)], [7] * 3000, [1] * 500 + [100_000] + [1] * 500, [], [draw.randrange(1, 10**6) for _ in range(300)]):
        offsets = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))])
        ranks, starts, slopes, residuals = fill_middle.fit(offsets)
        assert ranks[0] == 0 and len(residuals) == len(offsets) and np.abs(residuals.astype(int)).max() <= fill_middle.ERROR + 1
        for rank, offset in enumerate(offsets):
            held = np.searchsorted(ranks, rank, "right") - 1
            assert starts[held] + int(np.floor(slopes[held] * (rank - ranks[held]))) + int(residuals[rank]) == offset
    assert len(fill_middle.fit(np.arange(0, 70_000, 7))[0]) == 1  # evenly spaced: one segment


def plain_cut(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h4 % 100 < spm else "psm"
    out = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, form, len(prefix), len(middle), out, text


@pytest.mark.parametrize(("seed", "rate", "spm"), [(7, 100, 50), (1, 60, 100), (2, 0, 50)])
def test_fill_middle_equals_brute_force(spark, seed, rate, spm):
    draw = random.Random(1)
    texts = ODD + ["".join(draw.choice(["ab", "é", "\n", "中", "<", ">", "P", " "]) for _ in range(draw.randrange(200))) for _ in range(120)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, "a\nb\nc", "en", "s"), (3, "twice\nx\n", "en", "s"), (3, "twice\nx\n", "en", "s")]
    out = fill_middle.fill_middle(table(spark, rows), seed, rate, spm).collect()
    got = Counter(tuple(r) for r in out)
    assert got == Counter((i, *plain_cut(i, t, seed, rate, spm)) for i, t, _, _ in rows)
    assert fill_middle.fill_middle(table(spark, [])).count() == 0


def test_an_index_serves_many_seeds(spark, tmp_path):
    text = "\n".join(f"line {i}" for i in range(50))
    fill_middle.with_rank_index(table(spark, [(i, text, "", "") for i in range(20)])).write.parquet(str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index"))
    for seed in (3, 4):
        got = {r["doc_id"]: r["output"] for r in fill_middle.rearranged(stored, seed).collect()}
        assert got == {i: plain_cut(i, text, seed)[4] for i in range(20)}


# -- source divergence --------------------------------------------------------------------------------


def plain_divergence(rows, least_docs=10, top=10):
    tr = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
    found = [(lang or "", source or "", [w.decode() for w in (t or "").encode().translate(tr).split(b" ") if w]) for _, t, lang, source in rows]
    out = set()
    for lang in {x[0] for x in found}:
        docs, counts, sources = Counter(), {}, sorted({x[1] for x in found if x[0] == lang}, key=str.encode)
        for own, source, words in found:
            if own == lang:
                docs.update(set(words))
                counts.setdefault(source, Counter()).update(words)
        kept = [t for t, n in docs.items() if n >= least_docs]
        whole = sum(counts.values(), Counter())

        def share(own):
            total = sum(own[t] for t in kept)
            return {t: 1 + 10**9 * (own[t] + 2) // (total + 2 * len(kept)) for t in kept}

        shares, q = {s: share(counts[s]) for s in sources}, share(whole)
        for s in sources:
            gap = lambda x, y: (x - y) ** 2 // (x + y)
            pairs = [(-sum(gap(shares[s][t], shares[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-gap(shares[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and shares[s][t] > q[t]]
            out |= {(lang, s, "pair", o.decode(), -v, i + 1) for i, (v, o) in enumerate(sorted(pairs))}
            out |= {(lang, s, "term", t.decode(), -v, i + 1) for i, (v, t) in enumerate(sorted(terms)[:top])}
    return out


@pytest.mark.parametrize(("bits", "cells"), [(64, 1 << 19), (4, 1 << 19), (64, 16), (5, 30)])  # few bits: every digest is that of several terms
def test_source_divergence_equals_brute_force(spark, bits, cells):
    draw = random.Random(8)
    words = [f"W{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["É", "é", "中文", "ß"]
    rows = []
    for i in range(160):
        source = draw.choice(["a", "a", "b", "c", None, ""])
        own = words[:40] if source == "a" else words[20:]
        rows.append((i, draw.choice([" ", "-", "1", "\n"]).join(draw.choices(own, k=draw.randrange(25))), draw.choice(["en", "en", "fr", None]), source))
    rows += [(500, None, "en", "empty"), (501, "", "xx", "lonely"), (502, "1 2 3", "yy", "p"), (503, "odd", "yy", "q"), (5, rows[5][1], "en", "a"), (None, "Waa Waa", "en", "a")]
    got = [tuple(r) for r in source_divergence.source_divergence(table(spark, rows), digest_bits=bits, cells=cells).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_divergence(rows)
    assert any(r[2] == "pair" and r[4] == 0 for r in got) and any(r[2] == "term" for r in got)


def test_source_divergence_of_nothing(spark):
    assert source_divergence.source_divergence(table(spark, [])).count() == 0
    assert source_divergence.source_divergence(table(spark, [(1, "a", None, None)])).count() == 0


def test_term_counts_are_given_out_in_parts():
    texts = pa.RecordBatch.from_pydict({"lang": ["en"] * 40, "source": ["s"] * 40, "text": [f"aa t{i % 7}x b{'c' * i}" for i in range(40)]})

    class Frame:
        def mapInArrow(self, function, schema):
            return [r for b in function(iter([texts])) for r in b.to_pylist()]

    for held in (4, 1 << 19):
        rows = source_divergence.term_counts(Frame(), held_rows=held)
        total = Counter()
        for r in rows:
            if r["term"] is None:
                total[r["digest"]] += r["n"]
        names = {r["digest"]: r["term"] for r in rows if r["term"] is not None}
        assert {names[d]: n for d, n in total.items()} == Counter(w for i in range(40) for w in ("aa", "t", "x", "b" + "c" * i))


def test_only_digests_are_shuffled_until_the_end(spark):
    counted = source_divergence.term_counts(source_divergence._groups_and_texts(table(spark, []), "text", "lang", "source"))
    shape = counted.where("term IS NULL").groupBy("lang", "source", "digest").agg(F.sum("n"))._jdf.queryExecution().executedPlan().toString()
    assert "term" not in next(line for line in shape.split("\n") if "Exchange" in line)


# -- suffix family --------------------------------------------------------------------------------------


def plain_repeats(rows, length=50):
    first: dict[bytes, int] = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in sorted((x for x in data if x[0] is not None), key=lambda x: x[0]):
        for at in range(len(b) - length + 1):
            first.setdefault(b[at : at + length], i)
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for at in range(len(b) - length + 1 if i is not None else 0):
            if first[b[at : at + length]] < i:
                gone[at : at + length] = b"\1" * length
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return Counter(out)


def found_repeats(spark, rows, **settings):
    df = table(spark, [(i, t, "en", "s") for i, t in rows])
    return Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffix_family.without_repeats(df, **settings).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(suffix_family, "CHUNK", 700)
    draw = random.Random(seed)
    parts = ["ab", "ba", "aa", "é", "中", "x" * 60, "the quick brown fox ", "\n", "\0", "a" * 10]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randrange(70)))) for i in range(120)]
    passage = "".join(draw.choice("abcdefgh ") for _ in range(400))
    for i in range(200, 240):  # one passage, cut here and there, among own words
        low = draw.randrange(300)
        rows.append((i, f"own {draw.random()} {passage[low : low + draw.randrange(40, 200)]} {draw.random()}"))
    rows += [(300, None), (301, ""), (302, "y" * 49), (303, "z" * 50), (304, "z" * 50), (305, "z" * 51), (400, rows[0][1] + rows[1][1] + rows[2][1])]
    rows += [(None, passage), (None, passage), (230, passage), (230, passage), (230, "short"), (-5, passage[100:200]), (2**62, passage), (-(2**62), "q" * 80), (7, "q" * 80)]
    rows.append((500, "".join(draw.choice("abcd") for _ in range(30_000)) + passage + "k" * 3000))
    want = plain_repeats(rows)
    assert found_repeats(spark, rows) == want
    assert found_repeats(spark, rows, bucket_bytes=1 << 11) == want


def test_repeats_of_nothing(spark):
    assert found_repeats(spark, []) == Counter() and found_repeats(spark, [(None, "a" * 99)]) == Counter({(None, 99, 0, 0, b"a" * 99): 1})


def test_equal_windows_have_equal_anchors():
    draw = random.Random(4)
    text = "".join(draw.choice("abc ") for _ in range(3000)).encode()
    sizes = np.array([1200, 30, 1770])
    hashes, doc, first, counts = suffix_family.anchors(np.frombuffer(text, np.uint8), np.array([0, 1200, 1230]), sizes)
    assert [int(counts[doc == d].sum()) for d in range(3)] == [1151, 0, 1721]
    own = text[500:560]  # the same windows at the start of a text of their own
    alone, _, at, n = suffix_family.anchors(np.frombuffer(own, np.uint8), np.array([0]), np.array([60]))
    mine = {int(x): int(h) for h, f, c in zip(hashes[doc == 0], first[doc == 0], counts[doc == 0], strict=True) for x in range(f, f + c)}
    assert {500 + int(x): int(h) for h, f, c in zip(alone, at, n, strict=True) for x in range(f, f + c)} == {x: mine[x] for x in range(500, 511)}
    assert len(text) / len(first) > 12


def test_levels_grow_geometrically():
    draw = random.Random(9)
    family, seen = suffix_family.Family(), {}
    for batch in range(16):
        contexts = list({"".join(draw.choice("ab") for _ in range(draw.randrange(50, 80))).encode() for _ in range(draw.randrange(5, 30))})
        if batch % 3 == 0 and seen:
            contexts.append(next(iter(seen)))
        docs = np.arange(len(contexts)) + 100 * batch
        least, first, counts = suffix_family.scan(family, contexts, np.arange(len(contexts)), docs)
        for c, d in zip(contexts, docs.tolist(), strict=True):
            for i in range(len(c) - 49):
                seen[c[i : i + 50]] = min(seen.get(c[i : i + 50], d), d)
        for k, c in enumerate(contexts):
            assert least[first[k] : first[k] + counts[k]].tolist() == [seen[c[i : i + 50]] for i in range(len(c) - 49)]
        sizes = [len(level.places) for level in family.levels]
        assert sum(sizes) == len(seen) and all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False))
        for level in family.levels:
            windows = level.windows()
            assert (windows[1:] > windows[:-1]).all()
