"""The operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from oracle import TESTDATA, connect, differences
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tallyloom.llm import chat, decontaminate, exact_dedup, jaccard_join, language, packing, pii, quality, queries, substring, toxicity

FOLDER = str(TESTDATA / "sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "no id here", None, None, 1), (3, "a " * 3000, "en", "s", 1), (4, "x", None, None, None)]


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert differences(spark, connect(FOLDER), name, queries.queries()[name], queries.oracle_sql()[name], FOLDER) == []


def test_all_queries_are_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert len(names) == 14 and set(queries.oracle_sql()) <= set(entry.oracle_sql())


# -- 1


def test_leaks_are_those_of_brute_force_and_paraphrases(spark, documents):
    items = pd.read_parquet(f"{FOLDER}/benchmark.parquet")
    words = {i: re.findall(r"\w+", t.lower()) for i, t in zip(items.item_id, items.text)}
    grams = defaultdict(set)
    for i, w in words.items():
        for k in range(len(w) - 7):
            grams[tuple(w[k : k + 8])].add(i)
    hits = defaultdict(Counter)
    for doc, text in zip(documents.doc_id, documents.text):
        w = re.findall(r"\w+", text.lower())
        for k in range(len(w) - 7):
            hits[doc].update(grams.get(tuple(w[k : k + 8]), ()))
    expected = {(d, i) for d, c in hits.items() for i, n in c.items() if n >= (len(words[i]) - 7) / 2}
    # One item with every fourth word replaced, inside other text.
    item = max(words, key=lambda i: len(words[i]))
    changed = " ".join("zzz" if k % 4 == 3 else w for k, w in enumerate(words[item][:40]))
    more = [(10**6, f"{documents.text[0][:300]} {changed} {documents.text[1][:300]}"), (10**6 + 1, None), (10**6 + 2, "")]
    docs = spark.createDataFrame(documents[["doc_id", "text"]]).unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    bench = spark.createDataFrame(items)
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert found - {(10**6, item)} == expected and (10**6, item) in found
    kept = {r["doc_id"] for r in decontaminate.drop_leaks(docs, bench).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {d for d, _ in found}


def test_lcs():
    def plain(x, y):
        table = np.zeros((len(x) + 1, len(y) + 1), int)
        for i, a in enumerate(x):
            for j, b in enumerate(y):
                table[i + 1, j + 1] = table[i, j] + 1 if a == b else max(table[i, j + 1], table[i + 1, j])
        return table[-1, -1]

    random = np.random.default_rng(0)
    for _ in range(100):
        x, y = random.integers(1, 6, random.integers(1, 20)), random.integers(0, 6, random.integers(0, 30))
        assert decontaminate.lcs(decontaminate._masks(x), len(x), y.tolist()) == plain(x, y) == substring._common(x, y)


# -- 2, 3, 8


def test_marginals_equal_enumeration():
    random = np.random.default_rng(1)
    unary, moves, start = random.normal(size=9) * 2, random.normal(size=(2, 2)), 0.3
    first = np.array([1, 0, 0, 0, 1, 1, 0, 0, 0], bool)
    total, toxic, pairs = 0, np.zeros(9), np.zeros((9, 2, 2))
    for code in range(512):
        s = [code >> k & 1 for k in range(9)]
        weight = np.exp(sum(unary[k] * s[k] + (start * s[k] if first[k] else moves[s[k - 1], s[k]]) for k in range(9)))
        total += weight
        for k in range(9):
            toxic[k] += weight * s[k]
            pairs[k, s[k - 1], s[k]] += weight
    got = toxicity.marginals(unary, first, moves, start)
    assert np.allclose(got[0], toxic / total) and np.allclose(got[1][~first], (pairs / total)[~first])


def test_toxic_spans_and_scores():
    random = np.random.default_rng(2)
    clean = ["".join(random.choice(list("abcdefgh"), 5)) for _ in range(300)]
    text = lambda toxic: " ".join(random.choice(clean, 40)) + (" Vile, " if toxic else " ") + " ".join(random.choice(clean, 20))
    model = toxicity.fit([(text(k % 4 == 0), int(k % 4 == 0)) for k in range(400)])
    reader = toxicity.Reader(model)
    tokens = toxicity._TOKEN.findall("abc vile def")
    marginal = toxicity.marginals(*reader.unary([tokens])[:2], model.moves, model.start)[0]
    assert toxicity.runs("abc vile def", marginal)[0][:2] == (4, 8)
    assert toxicity.fit([]) is None and toxicity.fit([("a", 0)]) is None


def test_prior_and_quality_of_a_known_mixture():
    random = np.random.default_rng(3)
    good = lambda: " ".join("".join(random.choice(list("abcdefghijklm"), random.integers(2, 9))) for _ in range(60)) + "."
    bad = lambda: " ".join(["SPAM!!"] * int(random.integers(20, 60)))
    model = quality.fit([good() for _ in range(400)], [good() if k % 10 < 7 else bad() for k in range(800)])
    assert abs(model.prior - 0.7) < 0.1
    score = model.logits(np.array([quality.statistics(t) for t in (good(), bad())]))
    assert score[0] > 0 > score[1]


@pytest.mark.parametrize("name, least", [("op2_toxicity", 0.9), ("op3_quality", 0.85), ("op8_language", 0.98)])
def test_held_out_accuracy(spark, name, least):
    folder = str(TESTDATA / "sf0.01")
    found = queries.queries()[name](spark, folder).toPandas()
    if name == "op8_language":
        truth = pd.read_parquet(f"{folder}/documents.parquet").rename(columns={"lang": "truth"})
        found["predicted"] = found.lang_pred
    else:
        truth = pd.read_parquet(f"{folder}/labels.parquet").rename(columns={name.split("_")[1].replace("toxicity", "toxic"): "truth"})
    assert len(found) == 1000 and found.score.between(0, 1).all()
    modulus, rest = (4, 2) if name == "op8_language" else (5, 0)
    assert (found.held_out == [zlib.crc32(str(i).encode()) % modulus == rest for i in found.doc_id]).all()
    held = found[found.held_out].merge(truth[["doc_id", "truth"]], on="doc_id")
    assert (held.predicted == held.truth).mean() >= least


def test_codewords():
    for n in (2, 4, 9):
        code = language.codewords(n)
        assert code.shape[0] == n and min((x != y).sum() for i, x in enumerate(code) for y in code[:i]) >= 1
    assert (np.abs(language.codewords(9).sum(0)) < 9).all()


# -- 4, 5, 6


def test_similar_sets_always_share_a_signature():
    random = np.random.default_rng(4)
    counts = random.integers(0, 50, 1 << jaccard_join.COUNTERS_LOG2).astype(np.uint32)
    grains = dict.fromkeys(range(2, 64), 0.0)
    for n in [*range(1, 40), 95, 96, 200, 600]:
        for _ in range(5):
            x = np.unique(random.integers(0, 1 << 63, n).astype(np.uint64))
            drop = int(random.integers(0, n // 7 + 1))
            y = np.unique(np.concatenate([x[drop:], random.integers(0, 1 << 63, drop).astype(np.uint64)]))
            common = len(np.intersect1d(x, y))
            if 100 * common >= 75 * (len(x) + len(y) - common):
                assert np.isin(jaccard_join.signatures(x, grains, counts), jaccard_join.signatures(y, grains, counts)).any()


def test_large_groups_of_near_copies(spark):
    """A group larger than a block, of which some are linked with none, and copies of one text."""
    random = np.random.default_rng(5)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(400):
        words = base.copy()
        for at in random.choice(60, k % 5, replace=False):
            words[at] = f"x{k}_{at}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, " ".join(base[:50])) for k in range(50)] + [(2000, None), (2001, " "), (2002, "a b"), (2003, "A  b")]
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i, t in rows for w in [(t or "").lower().split()]}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for p, i in enumerate(ids):
        for j in ids[:p]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    assert found == {i: root(i) for i in ids}


def test_exact_copies(spark, odd, empty):
    marked = {(r["doc_id"], r["text"]): (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.mark_copies(odd).collect()}
    assert marked[2, ""] == (2, 3, True) and marked[1, None] == (2, 3, False) and marked[None, "no id here"] == (None, 1, True)
    kept = exact_dedup.drop_copies(odd)
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 2, 3, 4] and kept.columns == odd.columns
    clash = odd.withColumnRenamed("source", "kept").withColumnRenamed("lang", "group_size")
    assert exact_dedup.drop_copies(clash).columns == clash.columns
    assert exact_dedup.mark_copies(empty).count() == 0 and exact_dedup.drop_copies(empty).count() == 0


def test_copies_beside_columns_of_any_name(spark):
    columns = ["doc_id", "text", "__copy_id", "__copy_full", "__COPY__x", "n", "at"]
    docs = spark.createDataFrame([(k, "abc" * (k % 3), 7, "own", "y", 1, 2) for k in range(6)], columns)
    marked = exact_dedup.mark_copies(docs)
    assert marked.columns == [*columns, "keep_id", "group_size", "kept"]
    assert sorted(marked.select("doc_id", "keep_id", "group_size", "kept", "__copy_id", "__copy_full").collect()) == [
        (k, k % 3 + 3, 2, k >= 3, 7, "own") for k in range(6)
    ]
    assert exact_dedup.drop_copies(docs).columns == columns


@pytest.mark.parametrize("bits", [1, 64, 1 << 28])
def test_copies_whatever_the_bitmap_lets_through(spark, monkeypatch, bits):
    """Equal lengths, equal prefixes, and equal texts; a full bitmap only costs hashes."""
    monkeypatch.setattr(exact_dedup, "BITMAP_BITS", bits)
    texts = [f"{'p' * 200}{k % 40:03d}" for k in range(100)] + [f"{k:04d}" for k in range(300)] + ["x" * k for k in range(300)] + [None, "", "x" * 5_000_000, "x" * 5_000_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups: dict[str, list] = {}
    for k, text in enumerate(texts):
        groups.setdefault(text or "", []).append(k)
    expected = sorted((k, max(g), len(g), k == max(g)) for g in groups.values() for k in g)
    assert sorted(exact_dedup.mark_copies(docs).select("doc_id", "keep_id", "group_size", "kept").collect()) == expected


def test_only_rows_that_share_a_prefix_are_hashed_in_full(spark):
    docs = spark.createDataFrame([(0, "aaaa"), (1, "aaaa"), (2, "bbbb"), (3, "ccccc")], "doc_id long, text string")
    hashed, _ = exact_dedup._joined(docs.withColumn("__copy_id", F.col("doc_id")), F.col("text"), 128, "__copy_")
    assert sorted(r["doc_id"] for r in hashed.where("length(__copy_full) = 64").collect()) == [0, 1]


def test_passages(spark):
    random = np.random.default_rng(6)
    word = lambda: "".join(random.choice(list("abcdefghij"), 6))
    text = lambda n: [word() for _ in range(n)]
    passage, license_ = text(80), text(20)
    fuzzy = passage[:40] + text(1) + passage[41:]
    docs = [text(100) + p + text(100) for p in (passage, passage, fuzzy, license_, license_, [])]
    rows = [(k, " ".join(d)) for k, d in enumerate(docs)] + [(10, None), (11, "few words")]
    found = {r["doc_id"]: r for r in substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(found) == {0, 1, 2}
    assert (found[0]["start_word"], found[0]["end_word"]) == (100, 180) and found[2]["words"] == 80


def test_chains_go_around_noise():
    a, b = np.array([0, 10, 500, 20, 30]), np.array([0, 10, 15, 20, 30])
    assert chains_of(a, b)[0] == [0, 1, 3, 4]


def chains_of(a, b):
    return [c.tolist() for c in substring.chains(a, b)]


def test_chains_are_cut_where_few_words_are_equal(spark):
    random = np.random.default_rng(9)
    text = lambda n: ["".join(random.choice(list("abcdefghij"), 6)) for _ in range(n)]
    passage, seed, common = text(60), text(24), [text(60) for _ in range(8)]
    docs = [text(30) + passage + text(40) + seed + text(30) for _ in range(2)]
    docs += [text(30) + [w for part in common for w in part + text(20)] for _ in range(2)]
    rows = [(k, " ".join(d)) for k, d in enumerate(docs)]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = {k: sorted((r["start_word"], r["end_word"]) for r in found if r["doc_id"] == k) for k in range(4)}
    assert spans[0] == spans[1] == [(30, 90)]
    for k in (2, 3):
        assert all(any(s <= 30 + 80 * i and 90 + 80 * i <= e for s, e in spans[k]) for i in range(8))


def test_parts_of_a_chain_are_all_that_have_the_identity():
    random = np.random.default_rng(10)
    for _ in range(60):
        x, y, anchors = [], [], []
        for _ in range(int(random.integers(2, 7))):
            run = random.integers(100, 60_000, int(random.integers(8, 40))).tolist()
            anchors.append((len(x), len(y)))
            x += run + random.integers(0, 6, int(random.integers(0, 30))).tolist()
            y += run + random.integers(0, 6, int(random.integers(0, 30))).tolist()
        x, y, anchors = np.array(x, np.uint16), np.array(y, np.uint16), np.array(anchors)
        pairs = substring.matched(x, y, anchors)
        assert (np.diff(pairs, axis=0) > 0).all() and (x[pairs[:, 0]] == y[pairs[:, 1]]).all()
        found, n = substring.aligned(x, y, anchors), len(pairs)
        good = [(i, j) for i in range(n) for j in range(i, n) if j - i + 1 >= substring.IDENTITY * max(pairs[j] - pairs[i] + 1) - 1e-9 and min(pairs[j] - pairs[i] + 1) >= substring.STRETCH]
        assert all(any(p <= pairs[i][0] and pairs[j][0] < e for p, e, *_ in found) for i, j in good)
        assert all(f[4] >= substring.IDENTITY - 1e-9 for f in found)
        for gap in ((x[:50], y[:50]), (x[-40:], y[-60:])):
            assert len(substring._equal_in_order(*gap)) == substring._common(*gap)


def test_a_passage_is_shared_with_one_partner(spark):
    random = np.random.default_rng(11)
    text = lambda n: ["".join(random.choice(list("abcdefghij"), 6)) for _ in range(n)]
    lines, boilerplate = [text(17) for _ in range(4)], [text(30) for _ in range(2)]
    whole = [w for line in lines for w in line]
    docs = {k: text(40) + whole + text(40) for k in (500, 501)}
    # Each line, and each two neighbouring ones, are frequent elsewhere, in documents before and after these.
    pairs = [lines[k] + lines[k + 1] for k in range(3)] + lines
    docs |= {k + shift: text(40) + part + text(40) for k, part in enumerate(pairs) for shift in (0, 20, 900, 920)}
    # Two short boilerplates, side by side in one document alone.
    docs |= {700: text(40) + boilerplate[0] + boilerplate[1] + text(40), 600: text(40) + boilerplate[0] + text(40), 800: text(40) + boilerplate[1] + text(40)}
    rows = [(k, " ".join(d)) for k, d in docs.items()]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["start_word"], r["end_word"], r["partner_id"]) for r in found) == [(500, 40, 108, 501), (501, 40, 108, 500)]


def test_fuzzy_passages_of_frequent_lines(spark):
    """One word of 68 changed, every line and each two neighbouring ones frequent in other documents."""
    random = np.random.default_rng(12)
    text = lambda n: ["".join(random.choice(list("abcdefghij"), 6)) for _ in range(n)]
    docs, changed = {}, range(17, 51, 2)
    for n, at in enumerate(changed):
        lines, base = [text(17) for _ in range(4)], 10_000 * n
        whole = [w for line in lines for w in line]
        docs[base + 500] = text(40) + whole + text(40)
        docs[base + 501] = text(40) + whole[:at] + text(1) + whole[at + 1 :] + text(40)
        parts = [lines[k] + lines[k + 1] for k in range(3)] + lines
        docs |= {base + k + shift: text(40) + part + text(40) for k, part in enumerate(parts) for shift in (0, 20, 900, 920)}
    rows = [(k, " ".join(d)) for k, d in docs.items()]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    asked = {10_000 * n + 500 + k for n in range(len(changed)) for k in (0, 1)}
    assert {r["doc_id"] for r in found} <= asked
    assert sum(r["start_word"] <= 42 and r["end_word"] >= 106 for r in found) >= 0.9 * len(asked)


def test_long_runs_that_others_have_are_found_by_brute_force(spark, documents):
    """Each run of 51 words of a document that another one has lies in one of its passages."""
    texts = {int(i): (t or "").lower().split() for i, t in zip(documents["doc_id"], documents["text"])}
    holders: dict[tuple, set] = {}
    for doc, words in texts.items():
        for k in range(len(words) - substring.RUN + 1):
            holders.setdefault(tuple(words[k : k + substring.RUN]), set()).add(doc)
    found: dict[int, list] = {}
    for r in substring.repeated_passages(spark.createDataFrame(documents[["doc_id", "text"]])).collect():
        found.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"]))
    shared = [(doc, k) for doc, words in texts.items() for k in range(len(words) - substring.RUN + 1) if len(holders[tuple(words[k : k + substring.RUN])]) > 1]
    assert shared and all(any(s <= k and k + substring.RUN <= e for s, e in found.get(doc, ())) for doc, k in shared)


def test_words_said_again_and_again_have_few_seeds():
    random = np.random.default_rng(13)
    for period in (1, 2, 7, 16, 40):
        codes = np.concatenate([random.integers(0, 2**40, 60), np.tile(random.integers(0, 2**40, period), 2000 // period), random.integers(0, 2**40, 60)]).astype(np.uint64)
        found, at = substring.seeds_of(codes)
        assert len(at) < len(codes) / 4 and (np.diff(at) <= substring.SPREAD).all()
        assert all(min(hashes) in found[(at >= k) & (at < k + substring.SPREAD)] for k, hashes in enumerate(np.lib.stride_tricks.sliding_window_view(hashes_of(codes), substring.SPREAD)))
        whole = np.arange(len(codes) - substring.SEED + 1)
        keys, positions, _ = substring._longer_keys((codes >> np.uint64(24)).astype("<u2"), whole, np.ones(len(whole), bool))
        places: dict[int, list] = {}
        for key, k in zip(keys.tolist(), positions.tolist()):
            places.setdefault(key, []).append(k)
        assert all(len(x) <= 2000 / (substring.SPREAD / 2) + 3 for x in places.values())


def hashes_of(codes):
    n = len(codes) - substring.SEED + 1
    return substring.mix64(sum((codes[k : n + k] * substring._POWERS[k] for k in range(substring.SEED)), np.zeros(n, np.uint64)))


def test_words_that_two_documents_say_again_and_again_are_found(spark):
    random = np.random.default_rng(14)
    text = lambda n: ["".join(random.choice(list("abcdefghij"), 6)) for _ in range(n)]
    rows = [(k, " ".join(text(40) + ["again"] * n + text(40))) for k, n in enumerate((60, 300))]
    rows += [(k + 2, " ".join(text(40) + ["so", "on"] * n + text(40))) for k, n in enumerate((26, 90))]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["start_word"], r["end_word"]) for r in found) == [(0, 40, 100), (1, 40, 340), (2, 40, 92), (3, 40, 220)]


def test_every_partner_is_met_where_asked_for(spark, monkeypatch):
    """Each of the documents of a passage has another word of it changed."""
    monkeypatch.setattr(substring, "PLACES", 3)
    random = np.random.default_rng(15)
    text = lambda n: ["".join(random.choice(list("abcdefghij"), 6)) for _ in range(n)]
    passage = text(90)
    rows = [(k, " ".join(text(40) + passage[: 7 * k + 5] + text(1) + passage[7 * k + 6 :] + text(40))) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    met = {(r["a"], r["b"]) for r in substring.stretches(docs, every=True).where("a_end - a_start > 50").collect()}
    assert met == {(a, b) for b in range(12) for a in range(b)}
    whole = {r["doc_id"]: r for r in substring.repeated_passages(docs, every=True).collect()}
    assert len(whole) == 12 and all(r["words"] >= 75 for r in whole.values())


def test_every_partner_is_met_unasked(spark, monkeypatch):
    """Whoever shares a passage meets, in several passes over the documents, too; copies of a text count one by one."""
    random = np.random.default_rng(16)
    text = lambda n: ["".join(random.choice(list("abcdefghij"), 6)) for _ in range(n)]
    passage = text(90)
    rows = [(k, " ".join(text(40) + passage[: 7 * k + 5] + text(1) + passage[7 * k + 6 :] + text(40))) for k in range(12)]
    copy = " ".join(text(120))
    copies = {k: copy.upper() if k == 33 else copy for k in (30, 31, 32, 33, 34)}
    docs = spark.createDataFrame(rows + list(copies.items()) + [(20, rows[5][1]), (20, rows[5][1])], "doc_id long, text string")
    asked = {(a, b) for b in [*range(12), 20] for a in [*range(12), 20] if a < b} | {(a, b) for b in copies for a in copies if a < b}
    for name, value in (("FREQUENT", 2), ("MATCHES", 50)):
        monkeypatch.setattr(substring, name, value)
    met = {(r["a"], r["b"]) for r in substring.stretches(docs).where("a_end - a_start > 50").collect()}
    assert met == asked
    found = {r["doc_id"]: r for r in substring.repeated_passages(docs).collect()}
    assert set(found) == {*range(12), 20, *copies}
    for k in copies:
        assert (found[k]["start_word"], found[k]["end_word"], found[k]["partners"], found[k]["partner_id"]) == (0, 120, 4, 31 if k == 30 else 30)
    assert found[5]["words"] == found[20]["words"] == 170
    assert all(found[k]["partner_id"] == (1 if k == 0 else 0) for k in [*range(12), 20])


def test_each_two_documents_of_a_long_run_meet(spark, documents):
    holders: dict[tuple, set] = {}
    for i, t in zip(documents["doc_id"], documents["text"]):
        words = (t or "").lower().split()
        for k in range(len(words) - substring.RUN + 1):
            holders.setdefault(tuple(words[k : k + substring.RUN]), set()).add(int(i))
    asked = {(a, b) for some in holders.values() for a in some for b in some if a < b}
    met = {(r["a"], r["b"]) for r in substring.stretches(spark.createDataFrame(documents[["doc_id", "text"]])).where("a_end - a_start > 50").collect()}
    assert asked and asked <= met


def test_chains_take_the_best_match_in_reach():
    random = np.random.default_rng(3)
    for _ in range(40):
        met = np.unique(random.integers(0, 150, (int(random.integers(2, 80)), 2)), axis=0)
        a, b = met[:, 1], met[:, 0]
        score = np.ones(len(a))
        for k in range(len(a)):
            far = np.maximum(a[k] - a[:k], b[k] - b[:k])
            before = (a[:k] < a[k]) & (b[:k] < b[k]) & (far <= substring.GAP + substring.SEED)
            gains = score[:k] - substring.COST * (a[k] - a[:k] + b[k] - b[:k])
            score[k] += max(0, gains[before].max(initial=0))
        best = chains_of(a, b)[0]
        cost = substring.COST * (a[best[-1]] - a[best[0]] + b[best[-1]] - b[best[0]])
        assert abs(len(best) - cost - score.max()) < 1e-9


@pytest.mark.parametrize("apart", [100, 500])
def test_later_passages_of_a_pair_are_found(spark, apart):
    random = np.random.default_rng(8)
    text = lambda n: ["".join(random.choice(list("abcdefghij"), 6)) for _ in range(n)]
    long, short = text(200), text(60)
    rows = [(k, " ".join(text(30) + long + text(apart) + short + text(30))) for k in range(2)]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["start_word"], r["end_word"]) for r in found) == [(k, *x) for k in range(2) for x in ((30, 230), (230 + apart, 290 + apart))]


def test_every_language_is_drawn_whatever_the_order(spark):
    rows = [(200 * k + i, f"{word} text number", f"l{k}") for k, word in enumerate(["aa", "bb", "cc", "dd", "ee", "ff", "gg"]) for i in range(200 if k else 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    model = language.fit_language(docs, per_language=50, in_all=70)
    assert model.languages == [f"l{k}" for k in range(7)]


# -- 7


RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _spans(text):
    def good(kind, s):
        digits = re.sub("[^0-9]", "", s)
        return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in s.split(".")), "card": 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]

    return [f"{k}:{m.start()}:{m.end()}" for k, rule in RULES.items() for m in re.finditer(rule, text) if good(k, m.group())]


def test_base_spans_equal_the_rules(spark, documents):
    hard = ["a@b@c.de.x x@y 1.2.3.4.5.6.7.8.9 300.1.1.1 4111 1111 1111 1111 4111-1111-1111-1111", "+1 (22) 333-4444 +12 +", "a..@b-.c-.d", None, "", "@@a.b @x.y.z q@w.e@r.t"]
    random = np.random.default_rng(7)
    hard += ["".join(random.choice(list("ab1.@ +-()2"), 60)) for _ in range(300)]
    for text in hard:
        found = pii.matches(text or "")
        assert [f"{k}:{s}:{e}" for k in pii.KINDS for s, e, ok in found[k] if ok] == _spans(text or ""), text
    for row in queries.op7_pii(spark, FOLDER).collect():
        expected = ",".join(_spans(documents.text[documents.doc_id == row["doc_id"]].iloc[0]))
        assert hashlib.sha256(expected.encode()).hexdigest() == row["base_sha256"] and set(expected.split(",")) <= set(row["spans"].split(","))


def _plants(draw):
    """Personal data in forms that the rules don't know, by kind."""
    digits = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    return [
        ("phone", f"({draw.randrange(200, 999)}) {digits(3)}-{digits(4)}"), ("phone", f"0{draw.randrange(10, 99)} {digits(4)} {digits(4)}"),
        ("phone", "(212) 555-0142"), ("phone", "030 1234 5678"), ("phone", f"0{draw.randrange(100, 999)}/{digits(7)}"),
        ("email", f"jane.doe{digits(2)} (at) example (dot) org"), ("email", "info[at]firm.co.uk"), ("email", "a_b @ mail.net"),
        ("ip", "2001:db8:85a3:0:0:8a2e:370:7334"), ("ip", f"fe80::{draw.randrange(65536):x}"), ("ip", "10[.]0[.]3[.]17"),
        ("card", "378282246310005"), ("card", "4111.1111.1111.1111"),
    ]


def _numbers(draw):
    """What looks like it and is not."""
    digits = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    return [
        "978-3-16-148410-0", f"20{digits(2)}-{draw.randrange(1, 13):02}-{draw.randrange(1, 29):02}", f"{draw.randrange(1, 32)}/{draw.randrange(1, 13)}/20{digits(2)}",
        "4111 1111 1111 1112", "16:9:4:3", "12 000 000", f"No. {digits(3)}-{digits(3)}", "555.10", "1,250,000,000", "19-23", f"{digits(2)}.{digits(5)}",
    ]


@pytest.fixture(scope="module")
def pii_model(spark):
    return pii.fit_pii(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 5 > 0"))


def test_additions_find_planted_forms_and_no_look_alikes(spark, pii_model):
    held_out = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 5 = 0 AND length(text) > 300").orderBy("doc_id").limit(150)
    draw, found, planted, added = random.Random(5), {k: 0 for k in pii.KINDS}, {k: 0 for k in pii.KINDS}, 0
    rows, expected = [], {}
    for text in [r["text"] for r in held_out.collect()]:
        blanks = [k for k, c in enumerate(text) if c == " "]
        for kind, form in [*_plants(draw), *[(None, f) for f in _numbers(draw)]]:
            at = draw.choice(blanks) + 1
            expected[len(rows)] = (kind, at, at + len(form))
            rows.append((len(rows), text[:at] + form + " " + text[at:]))
    for row in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"), pii_model).collect():
        kind, start, end = expected[row["doc_id"]]
        additions = [(s["kind"], s["start"], s["end"]) for s in row["pii"] if not s["base"]]
        base = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in row["pii"] if s["base"])
        assert base == ",".join(_spans(row["text"]))
        added += len(additions)
        if kind:
            planted[kind] += 1
            found[kind] += (kind, start, end) in additions
    assert all(found[k] >= 0.8 * planted[k] for k in pii.KINDS), (found, planted)
    assert sum(found.values()) >= 0.9 * added, (found, added)


def test_disguises_are_proposed_whole_and_not_base(spark):
    draw = random.Random(1)
    spans = {"email": "jane@mail.example.org", "ip": "192.168.17.40", "card": "4111111111111111", "phone": "+49 30 1234567"}
    for kind, span in spans.items():
        for form in [f for _ in range(20) for f in pii.disguises(kind, span, draw)]:
            text = f"so {form} is it"
            assert (kind, 3, 3 + len(form)) in pii.candidates(text), form
            assert not any(good for several in pii.matches(text).values() for *_, good in several if kind != "card"), form


def test_a_corpus_without_personal_data_adds_nothing(spark):
    assert pii.fit_texts([]) is None and pii.fit_texts(["", "no numbers here", "only 12-12 and 1999"]) is None


# -- 9, 10


def test_reply_trees_and_escapes(spark):
    nasty = ["<|im_end|>", "<\\|", "\\", "\\\\<|x", "a\nb", "", None, "<\\\\|im_start|>\\n"]
    rows = [(1, k, k - 1 if k else None, 0.0, "assistant" if k % 2 else "us\\-er\n", t) for k, t in enumerate(nasty)]
    rows += [(2, 0, None, 0.0, "user", "q"), (2, 1, 0, 0.2, "assistant", "low"), (2, 2, 0, 0.9, "assistant", "high"), (2, 3, 9, 0.0, "user", "lost parent")]
    rows += [(3, 0, 1, 0.0, "user", "cycle"), (3, 1, 0, 0.0, "user", "cycle")]
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, score double, role string, text string")
    found = chat.format_paths(nodes, branches=None)
    read = found.select("tree", "branch", "rank", chat.read_turns("formatted").alias("turns"), chat.read_loss("formatted", "loss").alias("learned")).collect()
    by = {(r["tree"], r["branch"]): r for r in read}
    assert [t["text"] for t in by[1, 7]["turns"]] == [t or "" for t in nasty] and by[1, 7]["turns"][0]["role"] == "us\\-er\n"
    assert by[1, 7]["learned"] == "".join(t or "" for t in nasty[1::2])
    assert set(by) == {(1, 7), (2, 1), (2, 2), (2, 3)} and by[2, 2]["rank"] == 1
    best = chat.best_paths(nodes, branches=1).where("tree = 2").select("branch").distinct().collect()
    assert [r["branch"] for r in best] == [2]


def test_packing_is_gapless_and_reads_back(spark, documents):
    found = queries.op10_packing(spark, FOLDER).toPandas().sort_values(["sequence_id", "offset"])
    assert ((found.groupby("sequence_id").length.cumsum() - found.length) == found.offset).all()
    sizes = found.groupby("sequence_id").length.sum()
    assert sizes.max() <= 1024 and sum(0 if n & (n - 1) == 0 else 1024 - n for n in sizes) < 0.02 * sizes.sum()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc_id, text in zip(documents.doc_id, documents.text):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        own = found[found.doc_id == doc_id].sort_values("start")
        assert own.length.sum() == len(ids) == own.doc_tokens.iloc[0]
        for piece in own.itertuples():
            assert zlib.crc32(ids[piece.start : piece.start + piece.length].tobytes()) == piece.ids_crc32


def test_patterns_use_every_length_exactly():
    random = np.random.default_rng(8)
    histogram = Counter(int(x) for x in random.integers(1, 513, 3000)) + Counter({1024: 5})
    used, patterns = Counter(), packing.whole_patterns(histogram, 1024)
    for pattern, times in patterns:
        assert sum(n * c for n, c in pattern.items()) <= 1024
        used.update({n: c * times for n, c in pattern.items()})
    assert used == histogram


# -- odd rows, pipeline


def _runs(spark, docs):
    files = [public_tokenizers.path(f"byte_bpe_50k.{k}") for k in ("json", "tiktoken")]
    labels = docs.selectExpr("doc_id", "CAST(1 AS INT) AS quality", "CAST(NULL AS INT) AS toxic")
    return {
        "leaks": decontaminate.find_leaks(docs, docs.selectExpr("doc_id AS item_id", "text")),
        "toxic": toxicity.tag_toxic(docs, toxicity.fit_toxicity(docs, labels)), "quality": quality.score_quality(docs, quality.fit_quality(docs, labels)),
        "near": jaccard_join.near_duplicates(docs), "copies": exact_dedup.mark_copies(docs), "passages": substring.repeated_passages(docs),
        "pii": pii.find_pii(docs, pii.fit_pii(docs)), "language": language.identify(docs, language.fit_language(docs)),
        "packed": packing.pack(docs, *files, public_tokenizers.PATTERN),
    }


def test_odd_rows(spark, odd):
    counts = {name: df.count() for name, df in _runs(spark, odd.withColumns({"score": odd.source, "pii": odd.lang, "__scored": odd.lang, "__SCORED_": odd.source})).items()}
    assert all(counts[k] == len(ODD) for k in ("toxic", "quality", "near", "copies", "pii", "language")) and counts["packed"] >= len(ODD)


def test_empty_tables(spark, empty):
    assert all(df.count() == 0 for df in _runs(spark, empty).values())
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_paths(chat.turns_as_trees(turns)).count() == 0


def test_pipeline_keeps_what_each_stage_accepts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
        docs = spark.createDataFrame(kept.toPandas(), docs.schema)
    texts = [r["text"] for r in docs.collect()]
    assert len(texts) == len(set(texts))
    packed = corpus_pipeline.run(spark, FOLDER).toPandas()
    assert set(packed.doc_id) == {r["doc_id"] for r in docs.collect()}


LONG = [" " * 3_000_000, "\n" * 3_000_000 + "q", " \t" * 1_000_000, "7" * 1_000_000, "a\U0001e900b \U00010d41 x" * 50, "née 中 ́e 🙂"]


def test_runs_of_any_length_have_the_tokenizers_ids(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(k, text) for k, text in enumerate(LONG)]
    found = packing.pieces(spark.createDataFrame(rows, "doc_id long, text string"), path, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    library = Tokenizer.from_file(path)
    want = {}
    for k, text in rows:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, packing.END], "<u4")
        want |= {(k, a): (b - a, zlib.crc32(ids[a:b].tobytes()), len(ids)) for a, b in packing.cuts(len(ids), packing.CAPACITY)}
    assert {(r["doc_id"], r["start"]): tuple(r)[2:] for r in found.collect()} == want


def test_matches_in_line_have_the_scores_of_the_tree():
    random = np.random.default_rng(21)
    for _ in range(60):
        steps = random.choice([3, 9, 20, 60, 70, 80, 400], (int(random.integers(2, 60)), 2))
        a, b = steps.cumsum(0).T
        line, tree = substring._in_line(a, b), substring._in_tree(a, b)
        assert np.allclose(line[0], tree[0]) and line[1] == tree[1]


def test_unchanged_stretches_are_those_of_the_alignment(monkeypatch):
    random = np.random.default_rng(22)
    known = 0
    for _ in range(80):
        x = random.integers(0, 60_000, 120)
        y, at = np.concatenate([random.integers(0, 60_000, int(random.integers(0, 9))), x]), len(x)
        at = len(y) - at
        y[random.integers(0, len(y), int(random.integers(0, 3)))] = 7
        starts = np.sort(random.choice(100, 4, replace=False))
        starts = np.array([s for s in starts if (x[s : s + substring.SEED] == y[s + at : s + at + substring.SEED]).all()])
        if not len(starts):
            continue
        anchors = np.column_stack([starts, starts + at])
        found = substring.aligned(x, y, anchors)
        if substring._without_change(x, y, anchors) is not None:
            known += 1
            with monkeypatch.context() as m:
                m.setattr(substring, "_without_change", lambda *_: None)
                plain = substring.aligned(x, y, anchors)
            assert found == plain
    assert known > 20
