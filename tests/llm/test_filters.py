"""Personal data, line dedup, quality rules and language against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import language, line_dedup, outliers, pii, queries
from ledgerline.llm.common import text_slices
from llm_data import ODD, rows

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = [int(c) for c in match if c.isascii() and c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = sum(sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and doubled % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


PERSONAL = [
    "a@b.com_x@c.com a@b.c. a@a@a@b.cc..d@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.255 0.0.0.0 1.2.3", "x" + "9" * 5000,
    "é +1 (555) 123-4567 4111 1111 1111 1111  é 4111-1111-1111-1111 x", "+1 2 3 4 5 6 7 8 9 0- +12 + 3", "a" * 9000 + " " + "1 " * 9000,
    "1.1.1.1 " * 700,
]


def test_base_spans_equal_the_patterns(spark, stored):
    texts = [*ODD, *PERSONAL]
    found = {r["doc_id"]: r for r in queries.QUERIES["op1_personal_data"](spark, stored(texts)).collect()}
    for k, text in enumerate(texts):
        expected = base_spans(text)
        assert found[k]["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest(), text
        assert [found[k][f"n_{kind}"] for kind in pii.KINDS] == [sum(s.startswith(kind) for s in expected) for kind in pii.KINDS]
        assert set(expected) <= set(filter(None, found[k]["spans"].split(",")))


def test_method_adds_what_the_labelers_agree_on(spark, stored):
    plain = [f"mail x{k}.y@mail.com or phone +1 (212) 555-11{k:02d} now" for k in range(30)]
    loose = "phone (212) 555-7788 and bob [at] mail [dot] com, serial 1234/5678/9012/3456/7"
    found = queries.QUERIES["op1_personal_data"](spark, stored([*plain, loose])).where("doc_id = 30").first()
    assert {s.split(":")[0] for s in found["spans"].split(",")} == {"email", "phone"} and found["n_added"] == 2


def test_reliabilities_prefer_the_better_labeler(spark):
    random.seed(1)
    table = Counter()
    for _ in range(4000):
        truth = random.random() < 0.4
        vote = lambda accuracy: (1 if truth else -1) * (1 if random.random() < accuracy else -1)  # noqa: E731, B023
        table["email", vote(0.95), vote(0.9), vote(0.85), vote(0.55), 0] += 1.0
    patterns = spark.createDataFrame([(*k, n) for k, n in table.items()], ", ".join(f"{c} {'string' if c == 'kind' else 'int'}" for c in pii.PATTERN) + ", n double")
    got = {tuple(r)[1:6]: r["p"] for r in pii.reliabilities(patterns).collect()}
    assert got[1, 1, 1, -1, 0] > 0.95 and got[-1, -1, -1, 1, 0] < 0.05
    assert got[1, -1, -1, 1, 0] < got[-1, 1, 1, -1, 0]


def dedup_brute(docs, least=5):
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    for k, text in docs.items():
        for line in (text or "").split("\n"):
            holders[key(line)].add(k)
    heavy = {x: max(s) for x, s in holders.items() if len(x) >= 40 and len(s) >= least}
    return {k: "\n".join(x for x in (t or "").split("\n") if heavy.get(key(x), k) == k) for k, t in docs.items()}


def line_docs(n=60):
    random.seed(3)
    shared = [f"  This is SHARED line number {k} of the corpus, long enough\t" for k in range(8)]
    return {k: "\n".join(random.choice(shared) if random.random() < 0.5 else f"own line {k} {j} " * random.randint(1, 4) for j in range(random.randint(1, 9))) for k in range(n)}


def kept(index, docs):
    return {r["doc_id"]: r["text"] for r in line_dedup.without_lines(docs, index.dropped()).collect()}


def test_line_dedup_and_its_reversal(spark, make):
    texts = line_docs()
    docs = make([(k, t, "en", "s") for k, t in texts.items()])
    index = line_dedup.LineIndex.build(docs.where("doc_id < 30"), shard_keys=2)
    assert kept(index, docs.where("doc_id < 30")) == dedup_brute({k: t for k, t in texts.items() if k < 30})
    more = index.insert(docs.where("doc_id >= 30"))
    assert kept(more, docs) == dedup_brute(texts)
    less = more.delete(docs.where("doc_id % 3 = 0").select("doc_id"))
    assert kept(less, docs.where("doc_id % 3 <> 0")) == dedup_brute({k: t for k, t in texts.items() if k % 3})
    back = more.delete(docs.where("doc_id >= 30").select("doc_id"))
    assert rows(back.counts) == rows(index.counts)
    for at in (more, less, back):
        heavy = at.counts.where(f"n_docs >= {at.min_docs}").select("h1", "h2")
        total = at.filters.agg(F.sum("n_keys")).first()[0]
        assert (total or 0) == heavy.count()
        passed = at._probable().select("h1", "h2").distinct()
        assert heavy.join(passed, ["h1", "h2"], "left_anti").count() == 0


def test_cuckoo_filter_keeps_deletes_and_fills_up():
    keys = np.random.Generator(np.random.PCG64(1)).integers(0, 1 << 63, 3000, dtype=np.uint64)
    table = line_dedup.CuckooFilter.for_keys(len(keys))
    assert table.insert(keys) and table.contains(keys).all()
    table.delete(keys[:1500])
    assert table.contains(keys[1500:]).all() and table.contains(keys[:1500]).mean() < 0.01
    assert not line_dedup.CuckooFilter(4).insert(keys)


def statistics_brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    count = Counter(windows)
    cover = {j for k, w in enumerate(windows) if count[w] > 1 for j in range(k, k + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover)]


def test_statistics_equal_brute_force(spark, make):
    random.seed(9)
    texts = [*ODD, *("".join(random.choice("ab \n|é\t") for _ in range(random.randint(0, 400))) for _ in range(200))]
    found = {r["doc_id"]: list(r)[1:] for r in outliers.statistics(make(texts).select("doc_id", "text")).collect()}
    assert found == {k: statistics_brute(t) for k, t in enumerate(texts)}


def test_outliers_go_and_clean_rows_stay(spark, make):
    random.seed(4)
    word = lambda: "".join(random.choice("etaoinshr") for _ in range(random.randint(2, 8)))
    clean = [" ".join(word() for _ in range(random.randint(30, 200))) for _ in range(400)]
    junk = [" ".join(word() + random.choice(["###", "$$$", "%%%"]) for _ in range(60)) for _ in range(60)]
    docs = make([(k, t, "en", "hot" if k % 3 else "cold") for k, t in enumerate(clean + junk)])
    out = {r["doc_id"]: r for r in outliers.judge(docs).collect()}
    assert all(out[k]["kept"] for k in range(400))
    assert not any(out[k]["kept"] for k in range(400, 460))


def test_determinants_withstand_a_third_of_outliers(spark):
    random_numbers = np.random.Generator(np.random.PCG64(2))
    good = random_numbers.normal(0, 1, (300, outliers.DIM))
    bad = random_numbers.normal(30, 1, (60, outliers.DIM))
    table = spark.createDataFrame([("c", *map(float, x)) for x in np.vstack([good, bad])], "cell string, " + ", ".join(f"{a} double" for a in outliers.AXES))
    fit = outliers.determinants(table).first()
    assert np.abs(fit["centre"]).max() < 0.4
    scatter = np.linalg.inv(np.array(fit["precision"]).reshape(outliers.DIM, -1))
    assert 0.4 < np.diag(scatter).min() and np.diag(scatter).max() < 2.0


def test_chi_square_quantile():
    assert outliers.chi_square_quantile(0.95) == pytest.approx(9.4877, abs=1e-3)


def test_language_of_held_out_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang_pred <> 'und'")
    right = out.where("lang = lang_pred").count()
    assert out.count() > 20 and right >= 0.95 * out.count()
    assert out.agg(F.min("score") >= 0, F.max("score") <= 1).first()[:] == (True, True)


def test_undetermined_texts_and_single_language(spark, make):
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(make([*ODD, *["plain words here"] * 20])).collect()}
    assert found[0] == found[1] == found[6] == ("und", 0.0)
    assert found[20] == ("en", 1.0)


@pytest.mark.parametrize("classes", [2, 4, 7, 12])
def test_codewords_differ(classes):
    code = language.codewords(classes)
    distances = [int((a != b).sum()) for k, a in enumerate(code) for b in code[:k]]
    assert min(distances) >= max(1, code.shape[1] // 4)
    assert all(len(set(bit)) == 2 for bit in code.T)


def test_trigrams_see_whole_documents_only():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["abc", "", "Abc d", None])], ["text"])
    ((_, _, data, offsets),) = text_slices(batch)
    features, bounds = language.trigrams(data, offsets)
    assert bounds.tolist() == [0, 3, 3, 7, 7] and features[:3].tolist() == features[3:6].tolist()
