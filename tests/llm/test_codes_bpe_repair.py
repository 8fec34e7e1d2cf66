"""Vector codes, BPE and conversation repair against plain versions of the same."""

import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from oracle import TESTDATA
from tokenizers import Tokenizer

from tallyloom.llm import bpe, lloyd, queries, repair

FOLDER = str(TESTDATA / "sf0.001")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# -- 11


def plain_lloyd(vectors, parts, entries, rounds):
    """Codes, errors and entries by comparing everything with everything, in Python integers."""
    width = len(vectors[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in vectors]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p])) for p, x in enumerate(v)] for v in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                rows = [v[p] for v, f in zip(cut, found) if f[p][1] == k]
                if rows:
                    books[p][k] = tuple(sum(c) // len(rows) for c in zip(*rows))
    found = assign()
    return [[k for _, k in f] for f in found], [sum(d for d, _ in f) for f in found], books


def test_moved_entries_suffice():
    rng = np.random.default_rng(1)
    for _ in range(200):
        part, before = rng.integers(-3, 4, (40, 2)), rng.integers(-3, 4, (9, 2))  # many ties
        after = before.copy()
        moved = rng.random(9) < 0.3
        after[moved] = rng.integers(-3, 4, (int(moved.sum()), 2))
        moved = (after != before).any(1)
        code, held, took = lloyd.reassign(part, after, moved, *lloyd.rescan(part, before))
        want = lloyd.rescan(part, after)
        assert (code == want[0]).all() and (held == want[1]).all() and took <= part.shape[0] * 9


def test_distances_are_exact_for_large_integers():
    part, entries = np.array([[2**27, -(2**27)]]), np.array([[-(2**27), 2**27 - 1]])
    assert lloyd.distances(part, entries)[0, 0] == (2**28) ** 2 + (2**28 - 1) ** 2


def test_codes_are_those_of_plain_lloyd(spark):
    rng = random.Random(5)
    vectors = [[rng.choice([-1, -0.5, 0.25, 1.0009765625]) + rng.randint(-4, 4) / 1024 for _ in range(8)] for _ in range(90)]
    vectors += [vectors[3]] * 3
    ids = [*range(90), 3, 95, None]
    rows = [(i, v, None if k % 7 == 0 else k % 3, "own", k) for k, (i, v) in enumerate(zip(ids, vectors))]
    bad = [(1000, None, 1, "x", 0), (-1, [0.0, None] * 4, 1, "x", 0), (-2, [float("nan")] * 8, 1, "x", 0), (-3, [float("-inf")] * 8, 1, "x", 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int, codes string, __group int").repartition(5)
    codes, books = lloyd.compress(df, "embedding", "vec_id", ["vec_id", "label"], parts=4, entries=16, rounds=3)
    told = sorted((repr((r["vec_id"], r["label"])), r["codes"], r["error"], r["e"]) for r in lloyd.with_group_error(codes, "label", "e").collect())
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, vectors[k]))
    want_codes, errors, entries = plain_lloyd([[int(np.floor(x * 1024)) for x in vectors[k]] for k in order], 4, 16, 3)
    by_label = {}
    for k, e in zip(order, errors):
        by_label[rows[k][2]] = by_label.get(rows[k][2], 0) + e
    want = sorted((repr((rows[k][0], rows[k][2])), c, e, by_label[rows[k][2]]) for k, c, e in zip(order, want_codes, errors))
    assert told == want
    flat = ",".join(str(x) for p in entries for e in p for x in e)
    assert books.sha256() == hashlib.sha256(flat.encode()).hexdigest()


def test_settled_parts_compare_active_entries_only(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(16, 8))
    rows = [(i, (centers[i % 16] + rng.normal(size=8) * 0.01).tolist()) for i in range(400)]
    _, books = lloyd.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "embedding", "vec_id", ["vec_id"], entries=16)
    assert books.compared[0][0] == books.compared[0][1] == 400 * 4 * 16
    assert books.compared[-1][0] < books.compared[-1][1] / 2


def test_vectors_that_cannot_be_coded(spark):
    schema = "vec_id long, embedding array<float>, label int"
    none, books = lloyd.compress(spark.createDataFrame([(1, None, 1)], schema), "embedding", "vec_id", ["vec_id", "label"])
    assert none.count() == 0 and books.sha256() == hashlib.sha256(b"").hexdigest()
    assert lloyd.with_group_error(none, "label", "e").count() == 0
    for vectors in ([[1.0] * 4, [1.0] * 8], [[1.0] * 6], [[1e30] * 4]):
        df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], schema)
        with pytest.raises(ValueError):
            lloyd.compress(df, "embedding", "vec_id", ["vec_id"])
    one, books = lloyd.compress(spark.createDataFrame([(7, [0.5] * 4, None)], schema), "embedding", "vec_id", ["vec_id", "label"])
    assert [tuple(r) for r in one.collect()] == [(7, None, [0, 0, 0, 0], 0)]


# -- 12


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def lexicon_of(words, folder):
    path = folder / "words"
    path.write_bytes(bpe.compile_lexicon(words, TOKENIZER))
    return bpe.Lexicon(str(path))


def ids_of(encoder, texts):
    ids, counts = encoder.encode(texts)
    ends = np.cumsum(counts).tolist()
    return [ids[a:b].tolist() for a, b in zip([0, *ends], ends)]


def test_query_encodes_and_decodes_like_the_library(spark, library):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_bpe(spark, FOLDER).collect()}
    assert len(found) == len(docs)
    for doc_id, text in zip(docs.doc_id, docs.text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        told = library.decode(ids, skip_special_tokens=False)
        assert found[doc_id] == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(told.encode()).hexdigest(),
        )


PARTS = [
    "a", "b", "s", "t", "'", " ", "  ", "\n", "\t", "1", "²", ".", "!", "é", "ß", "中", "'s", "'re", "'ll", "'ve", "<|endoftext|>", "<|endof",
    "́", "😀", "\U0001e900", "\U00010d41", "Ɤ", "\x00", "\x85", "​", "　", "ll", "RE", "the", " walking", "talking",
]


@pytest.mark.parametrize("words", [[], ["the", " walking", "talking", "talk", "s", "'s", " ", "  ", "\n", "é", "aa", "ab"]])
def test_any_text_is_encoded_like_by_the_library(library, tmp_path, words):
    rng, encoder = random.Random(7), bpe.Encoder(lexicon_of(words, tmp_path), bpe.vocabulary(TOKENIZER))
    for _ in range(60):
        texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(50)]
        assert ids_of(encoder, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_very_long_words_and_runs(library, tmp_path):
    encoder = bpe.Encoder(lexicon_of(["a"], tmp_path), bpe.vocabulary(TOKENIZER))
    letters = "".join(random.Random(3).choices("abcdefgh", k=100_000))
    texts = [" " * 1_000_000, "\n" * 1_000_000 + "q", "a" * 1_000_000, letters, "word " * 1_000_000]
    assert ids_of(encoder, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_are_shared_from_both_ends(tmp_path):
    words = {b"talk": (1,), b"talking": (1, 9), b"walk": (2,), b"walking": (2, 9), b"x": (3, 4, 5)}
    arrays = bpe.minimal_transducer(sorted(words.items()))
    # One state per distinct rest: of nothing, alk, lk, k, (ing), ng, g, and the end.
    assert len(arrays["end"]) == 8 and len(arrays["key"]) == 9
    path = tmp_path / "words"
    path.write_bytes(bpe.to_file(arrays))
    asked = [*words, b"", b"tal", b"talkin", b"talkings", b"y"]
    found, ids, counts = bpe.Lexicon(str(path)).look_up(asked)
    ends = np.cumsum(counts)
    got = {w: tuple(ids[e - n : e].tolist()) for w, f, e, n in zip(asked, found, ends, counts) if f}
    assert got == words


def test_random_lexicons_give_their_ids(tmp_path):
    rng = random.Random(11)
    for n in (0, 1, 5, 300):
        words = {bytes(rng.choices(b"abc", k=rng.randint(1, 6))): tuple(rng.choices(range(4), k=rng.randint(0, 4))) for _ in range(n)}
        path = tmp_path / f"words-{n}"
        path.write_bytes(bpe.to_file(bpe.minimal_transducer(sorted(words.items()))))
        asked = list({*words, *(bytes(rng.choices(b"abcd", k=rng.randint(0, 8))) for _ in range(300))})
        found, ids, counts = bpe.Lexicon(str(path)).look_up(asked)
        ends = np.cumsum(counts)
        assert {w: tuple(ids[e - k : e].tolist()) for w, f, e, k in zip(asked, found, ends, counts) if f} == words


def test_words_are_counted_over_all_texts(spark, library):
    rows = [(1, "the cat, the  cat's"), (1, "the cat, the  cat's"), (None, None), (2, ""), (3, "x" * 100 + " the")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {}
    for _, text in rows:
        for word, _ in library.pre_tokenizer.pre_tokenize_str(text or ""):
            want[word.replace("Ġ", " ")] = want.get(word.replace("Ġ", " "), 0) + 1
    want.pop("x" * 100)  # longer than words of the lexicon may be
    assert {r["word"]: r["n"] for r in bpe.count_words(docs, TOKENIZER).collect()} == want
    for size in (0, 2, 5, 100):
        least = min(n for n in [*want.values(), 99] if n > 1 and sum(m >= n for m in want.values()) <= size)
        assert sorted(bpe.frequent_words(docs, TOKENIZER, size)) == sorted(w for w, n in want.items() if n >= least)


def test_odd_rows_are_encoded_and_decoded(spark, library):
    rows = [(1, None, "a", "b"), (1, None, "a", "b"), (None, "née <|endoftext|> x", "a", "b"), (2, "", None, None), (3, "z" * 300_000, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, __text string")
    lexicon = bpe.fit_lexicon(docs, TOKENIZER, size=3)
    coded = bpe.encode(docs, lexicon, ["doc_id"])
    told = bpe.decode(coded, TOKENIZER, ["doc_id", "ids"]).collect()
    want = [(i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, _, _ in rows]
    assert sorted(map(repr, map(tuple, told))) == sorted(map(repr, want))
    with pytest.raises(ValueError):
        bpe.encode(docs, lexicon, ["doc_id", "ids"])
    empty = docs.limit(0)
    assert bpe.encode(empty, bpe.fit_lexicon(empty, TOKENIZER), ["doc_id"]).count() == 0


def test_broken_characters_and_unknown_ids_are_decoded_like_by_the_library(spark, library):
    rng = random.Random(5)
    lists = [[rng.randrange(0, 50257) for _ in range(rng.randint(0, 12))] for _ in range(300)]
    lists += [[rng.randrange(90, 256) for _ in range(8)] for _ in range(300)]
    rows = [(i, ids) for i, ids in enumerate(lists)] + [(-1, None), (-2, [5, None, 999_999, 6])]
    told = {r["k"]: r["decoded"] for r in bpe.decode(spark.createDataFrame(rows, "k long, ids array<int>"), TOKENIZER, ["k"]).collect()}
    assert told.pop(-1) == "" and told.pop(-2) == library.decode([5, 6])
    assert told == {i: library.decode(ids, skip_special_tokens=False) for i, ids in enumerate(lists)}


# -- 13


def all_repairs(rows):
    """The cheapest edits, then the least letters, by trying every sequence of edits that may still be cheapest."""
    best = (4 * len(rows), "D" * len(rows))

    def go(i, cost, letters, initials):
        nonlocal best
        if cost > best[0] or not re.fullmatch("s?(ua)*u?", initials):
            return
        if i < len(rows):
            initial, must_go, truncated = rows[i]
            more = repair.TRUNCATED_COST * truncated
            go(i + 1, cost + 4, letters + "D", initials)
            if not must_go:
                go(i + 1, cost + more, letters + "K", initials + (initial or "?"))
                for role in "ua":
                    go(i + 1, cost + 3 + more, letters + "R", initials + role)
        elif re.fullmatch("(s?(ua)+)?", initials):
            best = min(best, (cost, letters))
        for role in "ua":
            go(i, cost + 3, letters + "I", initials + role)

    go(0, 0, "", "")
    return best


def plain_search(rows):
    """The same by keeping all letters of the best way into each state."""
    states = {0: (0, "")}

    def inserted(found):
        for state in (0, 1, 3, 2, 3, 2):
            if state in found:
                way = (found[state][0] + 3, found[state][1] + "I")
                after = 3 if state == 2 else 2
                found[after] = min(found.get(after, way), way)
        return found

    states = inserted(states)
    for initial, must_go, truncated in rows:
        found, more = {}, repair.TRUNCATED_COST * truncated
        for state, (cost, letters) in states.items():
            ways = [(state, cost + 4, "D")]
            if not must_go:
                after = 3 if state == 2 else 2
                ways += [(after, cost + more, "K")] if initial == "?sua"[after] else [(after, cost + more + 3, "R")]
                ways += [(1, cost + more, "K")] if state == 0 and initial == "s" else []
            for after, c, edit in ways:
                found[after] = min(found.get(after, (c, letters + edit)), (c, letters + edit))
        states = inserted(found)
    return min(states[s] for s in (0, 3) if s in states)


def searched(rows):
    search, told, waiting, most = repair.Search(), [], 0, 0
    for row in rows:
        decided = search.step(*row)
        told += decided
        waiting += 1 - sum(e != "I" for e, _ in decided)
        most = max(most, waiting)
    cost, rest = search.end()
    return (cost, "".join(e for e, _ in told + rest)), most


def test_search_finds_the_cheapest_least_edits():
    rng = random.Random(3)
    for _ in range(1500):
        rows = [(rng.choice(["u", "a", "s", "t", ""]), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randint(0, 5))]
        assert searched(rows)[0] == all_repairs(rows) == plain_search(rows)


def test_long_conversations_are_decided_on_the_way():
    rng = random.Random(4)
    for _ in range(150):
        weights = [rng.random() for _ in range(5)]
        gone, cut = rng.choice([(0.02, 0.05), (0.5, 0.3), (0.9, 0.2)])
        rows = [(rng.choices(["u", "a", "s", "t", ""], weights)[0], rng.random() < gone, rng.random() < cut) for _ in range(rng.randint(0, 300))]
        assert searched(rows)[0] == plain_search(rows)
    rows = [(rng.choice("ua"), rng.random() < 0.1, rng.random() < 0.1) for _ in range(20_000)]
    found, most = searched(rows)
    assert most < 50 and len(found[1]) >= 20_000


def plain_repair(rows):
    """What the query says of the (turn, role, text) of one conversation."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults, steps = set(), [], []
    for _, role, text in rows:
        bare = text.rstrip(repair.BLANKS)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        steps.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    cost, letters = plain_search(steps)
    lines, state, k = [], 0, 0
    for edit in letters:
        after = 3 if state == 2 else 2
        if edit == "I":
            lines.append("user:" if after == 2 else "assistant:")
            state = after
            continue
        _, role, text = rows[k]
        k += 1
        if edit != "D":
            state = 1 if edit == "K" and role[:1] == "s" else after
            lines.append(f"{('user' if state == 2 else 'assistant') if edit == 'R' else role}:{text}")
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())


ROLES, TEXTS = ["user", "assistant", "system", "tool", "", None, "unknown"], ["Yes.", "No", "", " \t\n", None, "Why?", "So! \n", " ", "x" * 5000]


def odd_conversations():
    rng = random.Random(9)
    rows = [(c, rng.choice([0, 1, 2, 3, 5, 9, None, -2]), rng.choice(ROLES), rng.choice(TEXTS)) for c in range(80) for _ in range(rng.randint(1, 12))]
    rows += [(None, 1, "user", "Hm."), (None, 2, "assistant", "Oh."), (200, None, None, None)]
    rows += [(201, 4, "user", "Again.")] * 50 + [(202, k, "user", "Again.") for k in range(50)]
    return rows


def test_repair_of_odd_rows(spark):
    rows = odd_conversations()
    df = spark.createDataFrame([(*r, "own", 1) for r in rows], "conv_id long, turn long, role string, text string, fault string, digest int").repartition(7)
    missing = {r["conv_id"]: r["gaps"] for r in repair.gaps(df).collect()}
    found = {r["conv_id"]: (missing[r["conv_id"]], *tuple(r)[1:]) for r in repair.digests(repair.repair(df)).collect()}
    by_id = {}
    for c, *row in rows:
        by_id.setdefault(c, []).append(tuple(row))
    assert found == {c: plain_repair(r) for c, r in by_id.items()}


def test_repaired_rows_alternate(spark):
    df = spark.createDataFrame(odd_conversations(), "conv_id long, turn long, role string, text string")
    kept = {}
    for r in sorted(repair.repair(df).where("edit <> 'D'").collect(), key=lambda r: r["number"]):
        kept[r["conv_id"]] = kept.get(r["conv_id"], "") + r["role"][:1]
    assert kept and all(re.fullmatch("s?(ua)+", initials) for initials in kept.values())


def test_query_repairs_what_it_damaged(spark):
    rows = pd.read_parquet(f"{FOLDER}/conversations.parquet")
    by_id = {int(c): [] for c in rows.conv_id}
    for c, turn, role, text in zip(rows.conv_id, rows.turn, rows.role, rows.text):
        kind = zlib.crc32(f"{c}:{turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by_id[int(c)] += [(int(turn), "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = {r["conv_id"]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, FOLDER).collect()}
    assert found == {c: plain_repair(r) for c, r in by_id.items()}


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair(none).count() == 0 and repair.digests(repair.repair(none)).count() == 0 and repair.gaps(none).count() == 0
