"""Packing, sharding, mixing, and the queries with SQL."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from check_oracle import compare, duck
from ledgerline.llm import hilbert, mixing, packing, queries
from ledgerline.llm.common import ranks, read_table
from llm_data import ODD, rows


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary())


def test_pieces_are_the_tokens_and_fill_sequences(spark, make, small):
    texts = [*ODD, *(r["text"] for r in read_table(spark, small, "documents").select("text").collect())]
    out = packing.pack(make(texts), queries.vocabulary(), with_ids=True).collect()
    own = tokenizer()
    ids = defaultdict(dict)
    space = defaultdict(list)
    for r in out:
        ids[r["doc_id"]][r["start"]] = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(bytes(r["ids"])) == 4 * r["length"]
        space[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, text in enumerate(texts):
        expected = [*own.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        assert [x for start in sorted(ids[k]) for x in ids[k][start]] == expected
    for slots in space.values():
        slots.sort()
        assert [o for o, _ in slots] == [sum(n for _, n in slots[:j]) for j in range(len(slots))] and sum(n for _, n in slots) <= packing.SEQUENCE
    total = sum(n for slots in space.values() for _, n in slots)
    assert sorted(space) == list(range(len(space))) and total >= 0.9 * (len(space) - 1) * packing.SEQUENCE


def test_words_of_one_hash_keep_their_own_ids(spark, make):
    """A Thue-Morse word and its complement collide under every polynomial hash modulo 2^64."""
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(2048))
    texts = [word, word.translate(str.maketrans("ab", "ba")), f"x {word} y", "plain"]
    out = packing.pack(make(texts * 2), queries.vocabulary(), with_ids=True).collect()
    found = {(r["doc_id"], r["start"]): np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in out}
    own = tokenizer()
    assert found == {(k, 0): [*own.encode(t, add_special_tokens=False).ids, packing.END_ID] for k, t in enumerate(texts * 2)}


def slice_of(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_a_worker_remembers_few_words_and_keeps_those_that_come_back(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 300)
    with open(queries.vocabulary(), encoding="utf-8") as f:
        tokens = packing.WordTokens(f.read())
    own, learnt = tokenizer(), []
    word_ids = tokens.word_ids
    tokens.word_ids = lambda word: learnt.append(word) or word_ids(word)
    for k in range(40):
        common = "the common words, of every slice." if k % 4 < 3 else ""
        texts = [f"{common} " + " ".join(f"w{n}x" for n in range(40 * k, 40 * k + 40)), common]
        ids, bounds = tokens.encode(*slice_of(texts))
        expected = [[*own.encode(t, add_special_tokens=False).ids, packing.END_ID] for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == expected
        assert len(tokens.keys) <= 300
    assert learnt.count("common") == 1 and learnt.count("w0x") == 1


def test_a_worker_with_many_words_stays_small():
    with open(queries.vocabulary(), encoding="utf-8") as f:
        tokens = packing.WordTokens(f.read())
    tokens.word_ids = lambda word: [1, 2, 3, 4]
    for k in range(6):
        tokens.encode(*slice_of([" ".join(f"w{n}" for n in range(100_000 * k, 100_000 * k + 100_000))]))
    assert sum(a.nbytes for a in vars(tokens).values() if isinstance(a, np.ndarray)) < 32e6


@pytest.mark.parametrize("sequence", [10, 64])
def test_shortest_pack_first_places_every_piece_once(sequence):
    random.seed(sequence)
    counts = {k: random.choice([0, 1, 3, 50]) for k in range(1, sequence + 1)}
    slots = packing.shortest_pack_first(counts, sequence)
    fills, taken = Counter(), Counter()
    for length, first, count, base, offset in zip(*slots.values()):
        taken[int(length)] += int(count)
        for k in range(count):
            fills[int(base + k)] += int(length)
    assert taken == Counter({k: n for k, n in counts.items() if n}) and max(fills.values()) <= sequence
    assert packing.shortest_pack_first({}, sequence)["length"].size == 0


def test_curve_visits_neighbours():
    import itertools

    for bits, dims in ((2, 2), (2, 3), (3, 2)):
        order = sorted(itertools.product(range(1 << bits), repeat=dims), key=lambda p: hilbert.curve_index(p, bits))
        assert sorted(hilbert.curve_index(p, bits) for p in order) == list(range(1 << bits * dims))
        assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(order, order[1:]))


def test_shards_are_even_runs_of_the_curve(spark, small):
    out = queries.QUERIES["op5_hilbert_shards"](spark, small).collect()
    docs = {r["doc_id"]: r["text"] for r in read_table(spark, small, "documents").collect()}
    shards = defaultdict(list)
    for r in out:
        assert r["size"] == len(docs[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(docs[r["doc_id"]].encode())
        shards[r["shard"]].append((r["slot"], r["curve"]))
    assert sorted(shards) == list(range(16)) and {len(s) for s in shards.values()} <= {len(docs) // 16, len(docs) // 16 + 1}
    last = -1
    for k in sorted(shards):
        slots = sorted(shards[k])
        assert [s for s, _ in slots] == list(range(len(slots)))
        assert all(a <= b for a, b in zip([last, *(c for _, c in slots)], (c for _, c in slots)))
        last = slots[-1][1]


def test_written_shards_are_read_back(spark, small, tmp_path):
    docs = read_table(spark, small, "documents")
    hilbert.write_shards(docs, hilbert.hilbert_shards(docs), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert rows(back.select(*docs.columns)) == rows(docs) and back.select("shard").distinct().count() == 16


def test_ranks_with_hot_keys_split(spark):
    table = spark.createDataFrame([(0 if k % 3 else k % 7, k) for k in range(500)], "key int, doc_id long")
    for across in (False, True):
        got = defaultdict(list)
        for r in ranks(table, "key", ["doc_id"], 10, across).collect():
            got[None if across else r["key"]].append(r["rank"])
        assert all(sorted(v) == list(range(len(v))) for v in got.values())


def fill(sizes, weights, cap):
    """Targets by sharing, capping and sharing the excess again."""
    total, names = sum(sizes), list(range(len(sizes)))
    target, left, open_ = [0.0] * len(sizes), float(total), set(names)
    while open_ and left > 1e-9:
        share = left / sum(weights[k] for k in open_)
        over = [k for k in open_ if target[k] + share * weights[k] > cap * sizes[k] + 1e-9]
        if not over:
            for k in open_:
                target[k] += share * weights[k]
            break
        for k in over:
            left -= cap * sizes[k] - target[k]
            target[k] = float(cap * sizes[k])
            open_.discard(k)
    return target


def test_targets_share_all_words(spark):
    random.seed(1)
    for n in (1, 2, 5, 9):
        sizes = [random.choice([0, 5, 100, 4000]) + random.randint(0, 9) for _ in range(n)]
        table = [(f"s{k}" if k < n - 1 else None, s) for k, s in enumerate(sizes)]
        got = {r["source"]: r for r in mixing.source_targets(spark.createDataFrame(table, "source string, size long")).collect()}
        expected = fill(sizes, [mixing.WEIGHTS[k % 3] for k in range(n)], 3)
        assert [got[name]["target"] for name, _ in table] == pytest.approx(expected)
        assert sum(expected) == pytest.approx(sum(sizes))


def test_mix_comes_near_its_targets_and_repeats(spark, small):
    run = queries.QUERIES["op10_source_mix"]
    out = run(spark, small).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, run(spark, small).collect()), key=repr)
    sums = defaultdict(lambda: [0, 0.0])
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        sums[r["source"]][0] += r["taken"]
        sums[r["source"]][1] = r["target"]
    assert sum(t for t, _ in sums.values()) == pytest.approx(sum(t for _, t in sums.values()), rel=0.2)
    docs = read_table(spark, small, "documents")
    copies = Counter(r["doc_id"] for r in mixing.mix(docs).collect())
    assert copies == Counter({r["doc_id"]: r["copies"] for r in out if r["copies"]})


def test_word_count(spark, make):
    got = {r["doc_id"]: r["size"] for r in mixing.measured(make(ODD)).collect()}
    assert got == {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in enumerate(ODD)}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, small, name):
    status, note = compare(spark, small, name, entry.queries()[name], entry.oracle_sql()[name], duck(small))
    assert status == "ok", note


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(re.match(r"op(\d+)_|pipeline", n)[0] for n in names if re.match(r"op\d+_|pipeline", n)) == sorted([*(f"op{k}_" for k in range(1, 14)), "pipeline"])


def test_pipeline_goes_on_with_the_predicted_language(spark):
    """The first stage decides what the mix sees: predicted languages, and no ambiguous or unreadable text."""
    import corpus_pipeline

    english, german = "the house and the tree of the king ", "der Baum und das Haus nicht mit dem Ufer "
    rows = [(k, (english if k % 2 else german) * (k % 7 + 3), "en" if k % 2 else "de", f"s{k % 3}", 0) for k in range(40)]
    rows += [(100, english * 4, None, "s0", 0), (101, german * 4, "en", "s1", 0), (102, "12 34", "en", "s0", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    told = {r["doc_id"]: r["lang"] for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert 102 not in told and told[100] == "en" and told[101] == "de" and len(told) == 42
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert kept.columns == docs.columns and corpus_pipeline.mix_sources(spark, kept, "").columns == docs.columns
    mixed = sorted(r["doc_id"] for r in corpus_pipeline.mix_sources(spark, kept, "").collect())
    assert mixed != sorted(r["doc_id"] for r in corpus_pipeline.mix_sources(spark, docs, "").collect())
