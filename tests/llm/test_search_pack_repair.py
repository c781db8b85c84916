"""Ranked search, swap packing and conversation repair against brute force."""

import hashlib
import heapq
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from salesloom.llm import conversation_repair, segments, sketch_search, swap_packing, turn_search
from salesloom.llm.queries import tokenizer_json
from salesloom.llm.swap_search import Bins
from tests.conftest import SMALL
from tests.llm.conftest import sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

# ranked search


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(docs, items, k=10):
    counts = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    held = [(doc_id, c) for doc_id, c in counts if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc_id, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, doc_id, -score) for rank, (score, _, _, doc_id) in enumerate(heapq.nsmallest(k, scored, key=lambda x: x[:3]), 1)]
    return Counter(out)


ITEMS_DDL = "item_id bigint, text string, doc_id string, score int, rank string"


def test_search_equals_brute_force(spark, edge_docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    items = [(1, sentence(1, 12)), (2, None), (3, ""), (4, "?! --"), (5, "nowhere ÜNÏCODE"), (5, "The RIVER"), (5, "The RIVER"), (None, "日本語 12345"), (6, sentence(5, 3000))]
    frame = spark.createDataFrame([(*item, "x", 1, "y") for item in items], ITEMS_DDL)
    expected = brute_search(rows, items)
    assert Counter(map(tuple, sketch_search.search(edge_docs, frame).collect())) == expected
    # Few cells, short spans and small blocks change nothing but the work.
    monkeypatch.setattr(sketch_search, "SKETCH", 8)
    monkeypatch.setattr(sketch_search, "SPAN", 50)
    monkeypatch.setattr(sketch_search, "BLOCK_TERMS", 20)
    monkeypatch.setattr(sketch_search.blocks, "__defaults__", (20,))
    assert Counter(map(tuple, sketch_search.search(edge_docs, frame).collect())) == expected


def test_bounds_are_bounds_and_most_documents_are_not_rescored():
    rng = random.Random(4)
    words = [f"w{k}".encode() for k in range(3000)]
    counts = [Counter(rng.choices(words, k=rng.randint(1, 400))) for _ in range(50)]
    sizes = np.array([10 + sum(c.values()) for c in counts])
    cells = sketch_search.Cells()
    folded = sketch_search.sketches(counts, sizes, cells)
    for row, count in enumerate(counts):
        for term, n in count.items():
            assert folded[row, cells[term]] >= 10**9 * n // (1000 * n + 8 * sizes[row])
    assert (folded > 0).sum() <= sum(map(len, counts))


def test_equal_scores_go_by_doc_id_and_repeated_rows_are_all_ranked(spark):
    docs = spark.createDataFrame([(i, "one two") for i in range(30, 0, -1)] + [(7, "one two"), (None, "one two"), (40, "three")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "two one one")], "item_id bigint, text string")
    got = sketch_search.search(docs, items).orderBy("rank").collect()
    assert [r.doc_id for r in got] == [1, 2, 3, 4, 5, 6, 7, 7, 8, 9] and [r["rank"] for r in got] == list(range(1, 11))


def test_search_of_nothing(spark, no_docs, edge_docs):
    items = spark.createDataFrame([(1, "the river")], "item_id bigint, text string")
    assert sketch_search.search(no_docs, items).count() == 0
    assert sketch_search.search(edge_docs, items.limit(0)).count() == 0
    assert sketch_search.search(edge_docs.where("text is null"), items).count() == 0


# segments


def test_segments_give_the_ids_of_the_tokenizer():
    coded = tokenizer_json("word_bpe_49k.json")
    tokenizer = Tokenizer.from_str(coded)
    tokenizer.encode_special_tokens = True
    encoder = segments.BatchEncoder(coded)
    texts = [None, "", " ", "  a  b ", "I'm we'll don't", "İSTANBUL ΣΑΣ ς", "<|endoftext|> <|startoftext|>x", "a\x0bb \x0cc \x1cd \x85e", "é.É,ß!À×÷.", "a" * 500]
    rng, letters = random.Random(1), "aB1s '\n\t.,!= é̸×÷ñ日—́\U0001f600 \x0b "
    texts += ["".join(rng.choices(letters, k=rng.randrange(30))) for _ in range(1500)]
    ids, places = encoder.ids(pa.array(texts, pa.string()), 1)
    for k, text in enumerate(texts):
        assert ids[places[k] : places[k + 1]].tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], text
    part, places = encoder.ids(pa.array(texts, pa.string()).slice(3, 4), 1)
    assert len(part) == places[-1] and encoder.ids(pa.array([], pa.string()), 1)[1].tolist() == [0]


def test_remembered_segments_stay_bounded():
    asked = []
    known = segments.Remembered(lambda xs: [asked.append(x) or x.encode() for x in xs], most=10)
    for k in range(100):
        assert known.of([f"s{k}", "again"]) == [f"s{k}".encode(), b"again"]
    assert asked.count("again") == 1 and len(known.new) + len(known.old) <= 24


# swap packing


def valid(bins, lengths, capacity):
    packed = bins.packed()
    assert sorted(itertools.chain(*packed)) == list(range(len(lengths)))
    assert all(sum(lengths[p] for p in held) <= capacity for held in packed)
    return len(packed)


@pytest.mark.parametrize("kind", range(5))
def test_swaps_improve_best_fit(kind):
    rng = random.Random(kind)
    low, high = [(1, 100), (34, 99), (20, 50), (51, 100), (30, 36)][kind]
    lengths = [rng.randint(low, high) for _ in range(600)]
    bins = Bins(lengths, 100)
    bins.best_fit()
    fitted = valid(bins, lengths, 100)
    squares = sum(f * f for f in bins.fill)
    bins.improve()
    improved = valid(bins, lengths, 100)
    assert bins.least_bins() <= improved <= fitted
    assert sum(f * f for f in bins.fill) >= squares and [sum(lengths[p] for p in held) for held in bins.held] == bins.fill
    assert len(swap_packing.pack_shard(lengths, 100)) <= improved


def test_swaps_reach_the_fewest_bins_of_small_shards():
    def fewest(lengths, capacity):
        best = len(lengths)

        def put(place, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if place == len(lengths):
                best = len(rooms)
                return
            for k, room in enumerate(rooms):
                if room >= lengths[place] and room not in rooms[:k]:
                    put(place + 1, [*rooms[:k], room - lengths[place], *rooms[k + 1 :]])
            put(place + 1, [*rooms, capacity - lengths[place]])

        put(0, [])
        return best

    rng = random.Random(8)
    gaps = []
    for _ in range(60):
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 11))), reverse=True)
        gaps.append(len(swap_packing.pack_shard(lengths, 20)) - fewest(lengths, 20))
    assert set(gaps) <= {0, 1} and gaps.count(0) >= 57


@pytest.mark.parametrize("shard", [4000, 20])
def test_packed_pieces_round_trip(spark, edge_docs, shard, monkeypatch):
    monkeypatch.setattr(swap_packing.place_pieces, "__defaults__", (swap_packing.SEQ_LEN, shard))
    docs = edge_docs.unionByName(spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text", "lang", "source", "n_chars", "'' AS size", "'' AS score", "'' AS kept", "1 AS _row"))
    tokenizer = Tokenizer.from_str(tokenizer_json("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    expected = Counter()
    for row in docs.collect():
        ids = [*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 1]
        expected.update((row.doc_id, k, 4096 * k, tuple(ids[4096 * k : 4096 * k + 4096])) for k in range(-(-len(ids) // 4096)))
    rows = swap_packing.pack(docs, tokenizer_json("word_bpe_49k.json")).collect()
    assert Counter((r.doc_id, r.piece, r.start, tuple(r.ids)) for r in rows) == expected
    sequences = {}
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        sequences.setdefault(r.sequence_id, []).append(r)
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    least = -(-sum(r.length for r in rows) // 4096)
    assert len(sequences) <= least + (0 if shard == 4000 else 3)


def test_packing_is_repeatable_and_takes_nothing(spark, no_docs):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    coded = tokenizer_json("word_bpe_49k.json")
    once, again = (Counter(map(tuple, swap_packing.pack(docs, coded, with_ids=False).collect())) for _ in range(2))
    assert once == again
    assert swap_packing.pack(no_docs, coded).count() == 0


# conversation repair


def least_edits(codes):
    """Cost and audit by the least way to each role, row by row."""

    def inserted(ways):
        for _ in range(3):
            for last, (cost, audit) in list(ways.items()):
                role = turn_search.NEXT[last]
                ways[role] = min(ways.get(role, (1 << 30, "")), (cost + 5, audit + "I"))
        return ways

    ways = {turn_search.NONE: (0, "")}
    for code in codes:
        after = {}
        for last, (cost, audit) in inserted(dict(ways)).items():
            for initial, more, rows, role in turn_search.EDITS[code][last]:
                if rows:
                    after[role] = min(after.get(role, (1 << 30, "")), (cost + more, audit + initial))
        ways = after
    ways = inserted(ways)
    return min(ways[last] for last in (turn_search.NONE, turn_search.ASSISTANT) if last in ways)


def test_branch_and_bound_finds_the_cheapest_edits():
    rng = random.Random(3)
    for k in range(1200):
        n = rng.randrange(0, 12) if k < 1000 else rng.randrange(60, 400)
        weights = [rng.random() for _ in range(16)] if k % 2 else [1] * 16
        codes = bytes(rng.choices(range(16), weights, k=n))
        assert turn_search.cheapest_edits(codes) == least_edits(codes)
        least = turn_search.bounds(codes)
        assert least[0] <= least_edits(codes)[0]


def test_long_conversations_are_searched_in_proportion():
    rng = random.Random(5)
    codes = bytes(rng.choices(range(16), k=30_000))
    cost, audit = turn_search.cheapest_edits(codes)
    assert (cost, audit) == least_edits_long(codes)


def least_edits_long(codes):
    """As ``least_edits``, with costs only, then the least audit along the costs to come."""
    n = len(codes)
    to_come = [None] * n + [turn_search._FINAL]
    for place in range(n - 1, -1, -1):
        taken = [min(c + to_come[place + 1][role] for _, c, rows, role in turn_search.EDITS[codes[place]][last] if rows) for last in range(4)]
        to_come[place] = tuple(min(taken[last], 5 + taken[turn_search.NEXT[last]], 10 + taken[turn_search.NEXT[turn_search.NEXT[last]]]) for last in range(4))
    place, last, audit, left = 0, turn_search.NONE, [], to_come[0][0]
    while place < n or turn_search._FINAL[last]:
        for initial, cost, rows, role in turn_search.EDITS[codes[place]][last] if place < n else turn_search.AT_END[last]:
            if cost + to_come[place + rows][role] == left:
                audit.append(initial)
                place, last, left = place + rows, role, left - cost
                break
    return to_come[0][0], "".join(audit)


def brute_repair(rows):
    """Report of one conversation's rows (turn, role, text) by the definitions."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, codes, counts = set(), [], Counter()
    for _, role, text in rows:
        solid = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        fault = 1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0
        seen.add((role, text))
        counts[fault] += 1
        codes.append(4 * (" sua".find(role[0]) if role[:1] in ("s", "u", "a") else 0) + fault)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit = least_edits(bytes(codes))
    said, last, at = [], "", 0
    for edit in audit:
        if edit in "IR":
            role = "assistant" if last == "u" else "user"
        elif edit == "K":
            role = rows[at][1]
        if edit != "D":
            last = role[0]
            said.append(f"{role}:{'' if edit == 'I' else rows[at][2]}")
        at += edit != "I"
    digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
    return (gaps, counts[1], counts[2], counts[3], illegal, cost, audit, digest), said


def brute_damage(rows):
    out = {}
    for conv_id, turn, role, text in rows:
        held = out.setdefault(conv_id, [])
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        role, text, drawn = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        if drawn == 0:
            continue
        text = "" if drawn == 1 else text.translate(str.maketrans("", "", ".!?")) if drawn == 2 else text
        held += [(turn, "user" if drawn == 4 else role, text)] * (2 if drawn == 3 else 1)
    return out


TURNS_DDL = "conv_id bigint, turn bigint, role string, text string, dropped string, code int, place string"


def made_turns():
    rng = random.Random(9)
    roles, texts = ["user", "assistant", "system", "", "tool", "u2", None, "System"], ["Yes.", "No", " \n", "", None, "Why?  ", "a ", "é!", "x" * 50_000 + "."]
    rows = [(c, None if rng.random() < 0.1 else rng.randrange(12), rng.choice(roles), rng.choice(texts)) for c in range(150) for _ in range(rng.randrange(1, 9))]
    rows += [(c, t, ["user", "assistant"][t % 2], f"Turn {t}.") for c in (500, 501) for t in range(400)]
    rows += [(None, t, "user", "Hm.") for t in (1, 2, None)] + [(600, t, None, None) for t in range(3)] + [(700, 1, "user", "A."), (700, 1, "user", "A."), (700, 1, "assistant", "B.")]
    return rows


def test_repair_equals_brute_force(spark):
    rows = made_turns()
    frame = spark.createDataFrame([(*row, "x", 1, "y") for row in rows], TURNS_DDL)
    got = conversation_repair.repair_report(conversation_repair.damage(frame)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: brute_repair(held)[0] for c, held in brute_damage(rows).items()}
    assert len(got) == len({r.conv_id for r in got})


def test_repaired_rows_are_those_of_the_digest(spark):
    rows = made_turns()[:400]
    damaged = conversation_repair.damage(spark.createDataFrame([(*row, "x", 1, "y") for row in rows], TURNS_DDL))
    found = conversation_repair.stored(conversation_repair.edits(conversation_repair.judged(damaged)))
    said = {}
    for r in sorted(conversation_repair.repaired_rows(damaged, found).collect(), key=lambda r: r.place):
        said.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert said == {c: lines for c, held in brute_damage(rows).items() if (lines := brute_repair(held)[1])}


def test_undamaged_rows_and_no_rows(spark):
    plain = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")], "conv_id bigint, turn bigint, role string, text string")
    assert tuple(conversation_repair.repair_report(plain).first())[1:8] == (0, 0, 0, 0, 0, 0, "KK")
    assert conversation_repair.repair_report(conversation_repair.damage(plain.limit(0))).count() == 0
