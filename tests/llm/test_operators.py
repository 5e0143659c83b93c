"""Each numbered operator against plain Python: nulls, empty texts, copies, extra columns, empty tables."""

from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rollwright.llm import (
    bpe_prefix,
    content_sort,
    id_shards,
    language_id,
    line_alignment,
    packing,
    preference,
    quality_rules,
    shingles,
    signature_join,
    tokens,
    toxicity,
)
from rollwright.llm.common import BYTE_VOCABULARY, WORD_VOCABULARY, tokenizer_path
from rollwright.llm.components import components

ODD = [
    None, "", " ", "\n", "a  b", "a   b  ", " \n a\tb\r\n", "it's we'll 'S", "a<|endoftext|>b", "<|startoftext|> Hi", "İ ΣΑΣ é a ̈b",
    "\x1ca\x1cb", "a\0b", "１２3 ½ 中文 कि 😀👩‍👩‍👧", "a" * 3000, "ab" * 700, "!?" * 300, "The same text.", "the same TEXT.", "The same text.",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, hash string"


def docs(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "clash", "clash") for i, t in enumerate(texts)], SCHEMA)


def test_encoders_equal_the_library(spark):
    for make, name in ((tokens.WordEncoder, WORD_VOCABULARY), (tokens.ByteEncoder, BYTE_VOCABULARY), (bpe_prefix.PrefixEncoder, BYTE_VOCABULARY)):
        ours, theirs = make(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
        for text in ODD:
            ids = theirs.encode(text or "", add_special_tokens=False).ids
            assert np.frombuffer(ours.encode(text), "<u4").tolist() == ids, (name, text)


def test_prefix_round_trip(spark):
    path = tokenizer_path(BYTE_VOCABULARY)
    got = bpe_prefix.decode_documents(bpe_prefix.encode_documents(docs(spark, ODD), path), path).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {i: t or "" for i, t in enumerate(ODD)}
    assert bpe_prefix.encode_documents(docs(spark, []), path).count() == 0


def test_shards_hold_and_find_every_document(spark, tmp_path):
    df = docs(spark, ODD).unionByName(docs(spark, ["again"])).repartition(3)  # id 0 twice: null and "again"
    path, folder = tokenizer_path(WORD_VOCABULARY), str(tmp_path / "shards")
    blocks = id_shards.write_shards(df, folder, path, end_id=2, vocabulary_size=49_408, block_ids=50)
    buckets = id_shards.write_index(spark, folder, bucket_keys=4)
    keys = spark.createDataFrame([(i, 0) for i in range(len(ODD))] + [(0, 1), (999, 0), (0, 7)], "doc_id long, copy long")
    found = id_shards.look_up(keys, folder, buckets)
    read = id_shards.read_documents(blocks)
    got = {(r["doc_id"], r["copy"]): bytes(r["ids"]) for r in found.join(read, ["shard", "block", "slot"]).collect()}
    theirs = Tokenizer.from_file(path)
    wanted = {(i, 0): t or "" for i, t in enumerate(ODD)} | {(0, 1): "again"}
    assert got == {
        k: np.array(theirs.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes() for k, t in wanted.items()
    }


def test_shards_of_many_empty_texts(spark, tmp_path):
    folder = str(tmp_path / "empty")
    df = spark.range(0, 60_000, 1, 4).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    blocks = id_shards.write_shards(df, folder, tokenizer_path(WORD_VOCABULARY), end_id=2, vocabulary_size=49_408)
    assert blocks.select(F.max(F.size("doc_ids"))).first()[0] <= 1 << 13
    assert id_shards.write_index(spark, folder) == 15
    found = id_shards.look_up(df.withColumn("copy", F.lit(0).cast("long")), folder, 15)
    starts = found.join(id_shards.block_starts(blocks), ["shard", "block"]).select("doc_id", (F.col("block_start") + F.col("first")).alias("start"), "length")
    assert starts.where("start <> doc_id OR length <> 1").isEmpty() and starts.count() == 60_000


def test_starts_count_the_ids_of_all_documents_before(spark, tmp_path):
    path, folder = tokenizer_path(WORD_VOCABULARY), str(tmp_path / "starts")
    texts = [t for t in ODD for _ in range(3)]
    blocks = id_shards.write_shards(docs(spark, texts).repartition(5), folder, path, end_id=2, vocabulary_size=49_408, block_ids=40, block_documents=3)
    places = id_shards._documents(blocks).join(id_shards.block_starts(blocks), ["shard", "block"])
    got = {r["doc_id"]: (r["block_start"] + r["first"], r["length"]) for r in places.collect()}
    theirs, at = Tokenizer.from_file(path), 0
    for i, t in enumerate(texts):
        n = len(theirs.encode(t or "", add_special_tokens=False).ids) + 1
        assert got[i] == (at, n)
        at += n
    empty = str(tmp_path / "none")
    assert id_shards.write_shards(docs(spark, []), empty, path, end_id=2, vocabulary_size=49_408).count() == 0
    assert id_shards.write_index(spark, empty) == 1 and id_shards.look_up(got_keys(spark), empty, 1).count() == 0


def got_keys(spark):
    return spark.createDataFrame([(0, 0), (None, 0)], "doc_id long, copy long")


def test_levels_are_minimal_and_perfect():
    keys = shingles.spread(np.arange(1, 5001, dtype=np.uint64))
    sizes, bits = id_shards.build_levels(keys)
    assert sorted(id_shards.slots(keys, sizes, bits)) == list(range(5000))


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_content_sort(spark, keep):
    texts = ODD + ["hot"] * 300
    got = {r["doc_id"]: r for r in content_sort.content_sort(docs(spark, texts), keep=keep).collect()}
    lower = [(t or "").translate({c: c + 32 for c in range(65, 91)}) for t in texts]
    for i, t in enumerate(lower):
        same = [j for j, other in enumerate(lower) if other == t]
        stays = (min if keep == "smallest" else max)(same)
        wanted = (stays, len(same), i == stays, hashlib.sha256(t.encode()).hexdigest())
        assert tuple(got[i])[1:] == wanted
    assert content_sort.content_sort(docs(spark, [])).count() == 0


def test_quality_measures_and_thresholds(spark):
    text = "one two three four five six one two three four five. ## \n\nsame line here\nsame line here\n \n"
    row = quality_rules.base_measures(docs(spark, [text]), "lang").first()
    words = text.split()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == (
        len(words), sum(map(len, words)), 2, 1, len(covered)
    )
    good = [" ".join(random.Random(i).choices("abcdefghijklmnop", k=60)) for i in range(900)]
    bad = [" ".join(["x#"] * 3 + random.Random(i).choices("abcdefghijklmnop", k=60)) + " ###" * 20 for i in range(50)]
    labels = spark.createDataFrame([(i, 1) for i in range(900)] + [(900 + i, 0) for i in range(50)], "doc_id long, quality int")
    out = quality_rules.quality_verdicts(docs(spark, good + bad), labels, limit=0.2).collect()
    assert sum(r["kept"] for r in out if r["doc_id"] < 900) >= 890
    assert not any(r["kept"] for r in out if r["doc_id"] >= 900)
    assert quality_rules.quality_verdicts(docs(spark, ODD), labels.limit(0)).count() == len(ODD)


def graded(spark, groups):
    """Measures of made texts: for each (stratum, symbol rate, how many), labelled as good."""
    rows = [(s, rate) for s, rate, n in groups for _ in range(n)]
    data = [(i, s, rate, 0, 0, 0, -100, False) for i, (s, rate) in enumerate(rows)]
    measured = spark.createDataFrame(data, "doc_id long, stratum string, symbol_rate long, dup_line_rate long, repeat_rate long, long_words long, short_text long, base_failed boolean")
    return measured, measured.select("doc_id", F.lit(1).alias("quality"))


def plain_cutoffs(groups, limit, risk, pooled):
    from math import comb

    grid = {m: sorted(c, reverse=True) for m, c in quality_rules.GRID.items()}
    share = limit / len(grid)
    tail = lambda n, r: 1.0 if r > n * share else sum(comb(n, k) * share**k * (1 - share) ** (n - k) for k in range(r + 1))
    counts: dict[str, list[int]] = {}
    for s, rate, n in groups:
        counts.setdefault(s, []).extend([rate] * n)
    scarce = [s for s, held in counts.items() if (1 - share) ** len(held) > risk * (1 - pooled) / len(grid) / len(counts)]
    own = {s: held for s, held in counts.items() if s not in scarce}
    out = set()
    for sets, alpha, names in ((own, risk * (1 - pooled), None), ({"": [x for s in scarce for x in counts[s]]} if scarce else {}, risk * pooled, scarce)):
        worst = {}
        for s, held in sets.items():
            for m, cuts in grid.items():
                own_tails = [tail(len(held), sum((x if m == "symbol_rate" else -100 if m == "short_text" else 0) > c for x in held)) for c in cuts]
                worst[s, m] = [max(own_tails[: i + 1]) for i in range(len(cuts))]
        left, level = sorted(worst, key=lambda f: worst[f][-1]), alpha
        for j, f in enumerate(left):
            if worst[f][-1] > alpha / (len(left) - j):
                level = alpha / (len(left) - j)
                break
        for (s, m), tails in worst.items():
            held = [c for c, t in zip(grid[m], tails, strict=True) if t <= level]
            out |= {(x, m, min(held)) for x in (names or [s]) if held}
    return out


@pytest.mark.parametrize("groups", [
    [("en", 0, 5000), ("fr", 0, 900), ("de", 0, 900)],  # one large, two pooled
    [("en", 0, 4990), ("en", 60, 10)],  # exactly at the limit of the stricter cutoffs: they are refused
    [("en", 0, 4998), ("en", 400, 1), ("en", 60, 1), ("fr", 0, 3000), ("fr", 25, 1), ("xx", 30, 40)],
    [("en", 0, 300)], [("en", 0, 1500), ("fr", 600, 1500)],
])
def test_cutoffs_equal_brute_force(spark, groups):
    got = {tuple(r) for r in quality_rules.cutoffs(*graded(spark, groups)).collect()}
    assert got == plain_cutoffs(groups, 0.01, 0.05, 0.5)
    if groups == [("en", 0, 4990), ("en", 60, 10)]:
        assert min(c for _, m, c in got if m == "symbol_rate") == 100


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 200: 100, 150: 100}


@pytest.mark.parametrize(("leaders", "block"), [(4, 256), (1, 3)])  # the second: lists of many blocks and components
def test_near_duplicates_equal_brute_force(spark, monkeypatch, leaders, block):
    monkeypatch.setattr(signature_join, "LEADERS", leaders)
    monkeypatch.setattr(signature_join, "BLOCK", block)
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [draw.choices(vocabulary, k=80) for _ in range(6)]
    texts = list(ODD)
    for words in base:
        for _ in range(12):
            own = list(words)
            for _ in range(draw.randint(0, 4)):
                own[draw.randrange(80)] = draw.choice(vocabulary)
            texts.append(" ".join(own))
    tr = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    sets = []
    for t in texts:
        w = (t or "").encode().translate(tr).split()
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set())
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in signature_join.near_duplicates(docs(spark, texts), 3, 85).collect()}
    assert got == {i: (len(sets[i]), root[i]) for i in range(len(texts))}


def test_ids_with_several_texts_join_their_links(spark):
    draw = random.Random(2)
    one, two = (" ".join(draw.choices([f"v{i}" for i in range(300)], k=90)) for _ in range(2))
    rows = [(4, one), (9, one + " x"), (9, two), (7, two + " y"), (2, "alone here now"), (9, one + " x"), (None, one), (11, two)]
    df = spark.createDataFrame([(i, t, "en", "s", 0, "", "") for i, t in rows], SCHEMA)
    got = sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in signature_join.near_duplicates(df, 3, 85).collect())
    assert got == [(-1, None, True), (2, 2, True), (4, 4, True), (7, 4, False), (9, 4, False), (9, 4, False), (9, 4, False), (11, 4, False)]
    assert signature_join.near_duplicates(docs(spark, []), 3, 85).count() == 0


def test_pairs_of_a_template_are_compared_once(spark):
    """Texts of one template that lie below the threshold: each pair is a candidate in one list only."""
    draw = random.Random(3)
    frame = [f"t{i}" for i in range(100)]
    texts = []
    for i in range(60):
        own = list(frame)
        for k in range(4):
            own[10 + 25 * k] = f"own{i}x{k}"
        texts.append(" ".join(own))
    draw.shuffle(texts)
    found = signature_join.signed(docs(spark, texts).select("doc_id", "text"), 3).select("doc_id", "n_shingles", "signature")
    ordered = signature_join.prefixes(found, 41)
    lists = ordered.select(F.explode("prefix").alias("token"), "doc_id").withColumn("component", F.col("doc_id")).join(found, "doc_id").join(ordered, "doc_id")
    sets = signature_join.full_sets(docs(spark, texts).select("doc_id", "text"), 3).select("doc_id", "half")
    lists = lists.join(sets, "doc_id")
    assert signature_join.block_pairs(lists, 41, 85).count() == 0  # refuted where they meet
    pairs = [tuple(r) for r in signature_join.block_pairs(lists, 41, 50).collect()]
    marks = {r["doc_id"]: r["signature"] for r in found.collect()}
    alike = {(a, b) for a in marks for b in marks if b < a and sum(x == y for x, y in zip(marks[a], marks[b], strict=True)) >= 41}
    assert len(pairs) == len(set(pairs)) and set(pairs) == alike and alike
    assert not any(not r["kept"] for r in signature_join.near_duplicates(docs(spark, texts), 3, 85).collect())


def test_packing_is_done_where_the_bound_is_met(spark):
    sizes = [(i, 700) for i in range(3000)]  # two a sequence: best-fit meets its bound at once
    pieces = spark.createDataFrame(sizes, "doc_id long, length long")
    rows = packing.pack(pieces, 2048, partition_pieces=500).collect()
    assert all(r["certified"] for r in rows) and len({r["sequence_id"] for r in rows}) == 1500
    draw = random.Random(1)
    pieces = spark.createDataFrame([(i, draw.randint(1, 2048)) for i in range(3000)], "doc_id long, length long").withColumn("certified", F.lit("x"))
    rows = packing.pack(pieces, 2048, partition_pieces=300).collect()
    lengths = np.array([r["length"] for r in rows])
    whole = packing.best_fit_decreasing(lengths, 2048)[0].max() + 1
    assert len(rows) == 3000 and len({r["sequence_id"] for r in rows}) <= whole * 1.01 + 1
    assert packing.lower_bound(np.array([700, 2000]), 2048, np.array([5, 2])) == packing.lower_bound(np.array([700] * 5 + [2000] * 2), 2048) == 5


def test_packing_places_everything_once(spark):
    pieces = packing.token_pieces(docs(spark, [*ODD, "long words " * 3000]), tokenizer_path(BYTE_VOCABULARY), 64, 0)
    rows = packing.pack(pieces, 64, partition_pieces=10).collect()
    held: dict[int, list] = {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] <= 256
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(held) <= -(-sum(r["length"] for r in rows) // 64) + 2
    assert packing.pack(pieces.limit(0), 64).count() == 0


def test_bound_is_never_over_a_packing():
    for seed in range(30):
        lengths = np.array(random.Random(seed).choices(range(1, 101), k=60))
        bins, offsets = packing.best_fit_decreasing(lengths, 100)
        assert packing.lower_bound(lengths, 100) <= bins.max() + 1
    assert packing.lower_bound(np.array([51] * 5), 100) == 5


def test_line_alignment(spark):
    a, b = "one two three four five six seven eight", "alpha beta gamma delta epsilon zeta eta theta"
    c = "red green blue black white pink grey brown"
    texts = [f"{a}\n{b}\nown line of the first one", f"start of the second text\n{a}\n{b}\nend", f"{b}\n{a}", None, "", f"{c}\nok", c]
    got = {r["doc_id"]: (r["text"], r["_partners"]) for r in line_alignment.without_aligned_lines(docs(spark, texts)).collect()}
    assert got[0] == (texts[0], None) and got[3] == (None, None) and got[4] == ("", None)
    assert got[1] == ("start of the second text\nend", 1)
    assert got[2] == ("", 1)  # a block that moved goes too
    assert got[6] == ("", 1)
    assert line_alignment.without_aligned_lines(docs(spark, [])).count() == 0


def left_of(spark, texts):
    return {r["doc_id"]: r["text"] for r in line_alignment.without_aligned_lines(docs(spark, texts)).collect()}


def test_passages_of_short_and_blank_lines_go(spark):
    spaced = "\n\n".join(" ".join(f"l{i}w{k}" for k in range(6)) for i in range(15))
    listed = "\n".join(f"item{i}" for i in range(12))
    got = left_of(spark, [f"first\n{spaced}", f"{spaced}\nsecond", f"{listed}\nthird", f"fourth\n{listed}", "item1\nitem2\nitem3"])
    assert got[1] == "second" and got[3] == "fourth" and got[4] == "item1\nitem2\nitem3"


def test_line_alignment_equals_brute_force(spark):
    draw = random.Random(3)
    lines = ["" if i % 5 == 4 else " ".join(f"l{i}w{k}" for k in range(draw.randint(1, 10))) for i in range(60)]
    places = [sorted(draw.sample(range(60), 45)) for _ in range(12)]  # in one order: nothing crosses
    texts = [[lines[p] if draw.random() < 0.9 else f"own {d} {p}" for p in held] for d, held in enumerate(places)]
    got = left_of(spark, ["\n".join(t) for t in texts])
    for d, mine in enumerate(texts):
        gone = set()
        for theirs in texts[:d]:
            for x in range(len(mine)):
                for y in range(len(theirs)):
                    n = 0
                    while x + n < len(mine) and y + n < len(theirs) and mine[x + n] == theirs[y + n]:
                        n += 1
                    if sum(len(line.split()) for line in mine[x : x + n]) >= 8:
                        gone |= set(range(x, x + n))
        assert got[d] == "\n".join(line for i, line in enumerate(mine) if i not in gone), d


def test_every_place_of_a_repeated_line_aligns(spark):
    again, one, two = (" ".join(f"{name}{k}" for k in range(9)) for name in "ruv")
    text = "\n".join([again, one, again, two, again])
    assert left_of(spark, [text, f"own\n{text}"])[1] == "own"


def test_passages_that_cross_in_one_partner_go_by_another(spark):
    first = "\n".join(" ".join(f"p{i}w{k}" for k in range(6)) for i in range(12))
    second = "\n".join(" ".join(f"q{i}w{k}" for k in range(6)) for i in range(10))
    turned = f"{second}\n{first}"
    assert left_of(spark, [f"{first}\n{second}", second, f"{turned}\nown"])[2] == "own"
    # The partner that helps comes after many that cross in the same way.
    got = left_of(spark, [*(f"{first}\nown {i}\n{second}" for i in range(6)), second, turned])
    assert got[7] == ""


def test_moved_passages_equal_brute_force(spark):
    """Blocks in any order: of a later document goes what an earlier one holds, and pairs are those with first holders."""
    draw = random.Random(6)
    blocks = ["\n".join(" ".join(f"b{i}l{j}w{k}" for k in range(5)) for j in range(draw.randint(2, 4))) for i in range(9)]
    texts = []
    for d in range(40):
        held = draw.sample(blocks, draw.randint(1, 9))
        texts.append("\n".join(x for i, block in enumerate(held) for x in (block, f"own {d} {i}")))
    got = left_of(spark, texts)
    seen: set[str] = set()
    for d, text in enumerate(texts):
        lines = text.split("\n")
        assert got[d] == "\n".join(line for line in lines if line not in seen), d
        seen |= set(lines)


def test_pairs_grow_with_the_documents(spark):
    first = "\n".join(" ".join(f"p{i}w{k}" for k in range(6)) for i in range(4))
    second = "\n".join(" ".join(f"q{i}w{k}" for k in range(6)) for i in range(4))
    for n in (32, 64):
        texts = [f"{first}\n{second}\nown {i}" if i % 2 else f"{second}\n{first}\nown {i}" for i in range(n)]
        got = line_alignment.without_aligned_lines(docs(spark, texts)).collect()
        # Two for those of the other order: the lines at the seam are first held by the first of these.
        assert sum(r["_partners"] or 0 for r in got) == n - 1 + n // 2 - 1
        assert all(r["text"] == f"own {r['doc_id']}" for r in got if r["doc_id"])


def test_long_texts_are_cut_in_one_go(spark):
    lines = [" ".join(f"l{i}w{k}" for k in range(8)) for i in range(30_000)]
    turned = "\n".join(line for i in range(0, 30_000, 3) for line in (*lines[29_997 - i : 30_000 - i], f"own {i}"))
    start = time.time()
    got = left_of(spark, ["\n".join(lines), turned])
    assert got[1] == "\n".join(f"own {i}" for i in range(0, 30_000, 3)) and time.time() - start < 120


def test_ids_that_repeat_lose_the_same_places(spark):
    a, b = "one two three four five six seven eight", "alpha beta gamma delta epsilon zeta eta theta"
    df = docs(spark, [a]).unionByName(docs(spark, ["", f"{a}\n{b}"]).where("doc_id = 1")).unionByName(docs(spark, ["", f"{b}\nx"]).where("doc_id = 1"))
    df = df.unionByName(df.where("doc_id = 0").withColumn("doc_id", F.lit(None).cast("long")))
    got = sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in line_alignment.without_aligned_lines(df).collect())
    assert got == [(False, 0, a), (False, 1, b), (False, 1, "x"), (True, None, a)]


def test_preference_pairs(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "hi", "x"), (1, 1, "assistant", "a b c d", "x"), (2, 0, "user", None, "x"), (None, 0, "user", "q", "x"),
         (3, 0, "assistant", "p q", "x"), (3, 1, "user", "r", "x"), (3, 2, "assistant", "s t", "x"), (1, 0, "user", "hi", "x")],
        "conv_id long, turn long, role string, text string, turns string",
    )
    chosen = preference.conversations(turns)
    got = {r["pair_id"]: r for r in preference.preference_pairs(chosen, preference.with_weaker_reply(chosen)).collect()}
    one = got[1]
    assert one["n_prompt_turns"] == 1 and one["prompt"] == "<|user|>\nhi<|end|>\n"
    assert [one["chosen"][s["start"] : s["end"]] for s in one["chosen_spans"]] == ["a b c d<|end|>\n"]
    assert [one["rejected"][s["start"] : s["end"]] for s in one["rejected_spans"]] == ["a b<|end|>\n"]
    assert got[2]["chosen"] == "" and got[2]["n_prompt_turns"] == 1 and got[3]["n_prompt_turns"] == 2 and len(got) == 3


def test_toxicity_learns_and_leaves_clean_alone(spark):
    draw = random.Random(3)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("ra", "lo", "mi", "ne")]
    texts, marks = [], []
    for i in range(400):
        toxic = i % 4 == 0
        own = draw.choices(words, k=30)
        if toxic:
            own[draw.randrange(30)] = draw.choice(["zorgle", "blinkov"])
        texts.append(" ".join(own))
        marks.append(int(toxic))
    df = docs(spark, [*texts, None, ""])
    labels = spark.createDataFrame(list(enumerate(marks)), "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in toxicity.toxicity(df, labels).collect()}
    assert [out[i]["predicted"] for i in range(400)] == marks and out[400]["predicted"] == out[401]["predicted"] == 0
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(400))
    assert toxicity.toxicity(df, labels.limit(0)).agg({"predicted": "max"}).first()[0] == 0


def test_language_fusion(spark):
    english, german = "the thing with this and that other ", "und der nicht sich eine schule ich "
    training = spark.createDataFrame([(english * 3, "en"), (german * 3, "de")], "text string, lang string")
    pages = spark.createDataFrame(
        [(i, f"http://a.{'de' if i % 2 else 'com'}/x", f'<html lang="{"de" if i % 2 else "en"}"><p>{german if i % 2 else english}</p>', 1) for i in range(40)]
        + [(40, "http://a.de/x", "<html><p>1</p>", 1), (41, None, None, 1)],
        "page_id long, url string, html string, declared int",
    )
    got = {r["page_id"]: r["language"] for r in language_id.page_languages(pages, training).collect()}
    assert [got[i] for i in range(41)] == ["de" if i % 2 else "en" for i in range(40)] + ["de"] and got[41] in ("de", "en")
    assert language_id.page_languages(pages.limit(0), training).count() == 0
    mixed = docs(spark, [english * 5] * 30 + [None, ""]).unionByName(docs(spark, [german * 5] * 30, lang="de"))
    assert language_id.documents_in_language(mixed).count() == 62


def test_every_language_is_known(spark):
    signs = [chr(0x4E00 + 2 * i) + chr(0x4E01 + 2 * i) for i in range(205)]
    training = spark.createDataFrame([(s * 5, f"x{i}") for i, s in enumerate(signs)], "text string, lang string")
    langs, tables = language_id.letter_tables(training)
    assert langs == sorted(f"x{i}" for i in range(205)) and tables.shape[0] == 205
    assert np.allclose(np.exp(tables.astype(float)).sum(axis=1), 1, atol=1e-4)
