"""Near-duplicates, lines and repeated bytes against brute force."""

import hashlib
import random

import numpy as np
import pytest

from skerry.llm import lines, linking, minhash, queries, suffixes


def union_find(n):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    return parent, find


def near_by_force(texts, k, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent, find = union_find(len(texts))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [(i, len(sets[i]), find(i), find(i) == i) for i in range(len(texts))]


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(spark, edge, edge_texts, words):
    got = minhash.near_duplicates(edge, words=words).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == near_by_force(edge_texts, words, 80)


def test_a_group_of_near_copies_with_chains(spark):
    rnd = random.Random(4)
    base = [f"w{rnd.randint(0, 500)}" for _ in range(120)]
    texts = []
    for k in range(120):
        w = list(base)
        for _ in range(rnd.randint(0, 14)):
            w[rnd.randrange(len(w))] = f"z{rnd.randint(0, 9999)}"
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = minhash.near_duplicates(df, words=2).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == near_by_force(texts, 2, 80)


def test_near_duplicates_of_nothing_null_ids_and_repeated_ids(spark, none):
    assert minhash.near_duplicates(none).count() == 0
    df = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "x y z"), (9, "x y z")], "doc_id long, text string")
    got = {tuple(r) for r in minhash.near_duplicates(df, words=2).collect()}
    assert got == {(None, 5, None, True), (7, 5, 7, True), (7, 2, 7, True), (9, 2, 7, False)}


def test_sketch_fills_every_coordinate_and_estimates_similarity():
    rng = np.random.default_rng(1)
    assert (minhash.sketch(np.array([3], np.uint64)) != np.uint64(2**64 - 1)).all()
    agree = []
    for _ in range(40):
        both, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (160, 20, 20))
        agree.append((minhash.sketch(np.concatenate([both, a])) == minhash.sketch(np.concatenate([both, b]))).mean())
    assert abs(np.mean(agree) - 0.8) < 0.02 and np.std(agree) < 0.04


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edits(rnd, a, n, letters):
    b = bytearray(a)
    for _ in range(n):
        op, i = rnd.randint(0, 2), rnd.randrange(len(b) or 1)
        if op == 0 or not b:
            b.insert(i, rnd.choice(letters))
        elif op == 1:
            del b[i]
        else:
            b[i] = rnd.choice(letters)
    return bytes(b)


def test_edit_distance_and_shared_keys():
    rnd = random.Random(3)
    for t in range(3000):
        most, letters = rnd.randint(0, 5), b"ab" if t % 2 else b"abcdefgh"
        a = bytes(rnd.choice(letters) for _ in range(rnd.randint(0, 25)))
        b = edits(rnd, a, rnd.randint(0, 6), letters)
        assert lines.edit_distance(a, b, most) == min(distance(a, b), most + 1)
    for _ in range(600):
        e = rnd.randint(1, 3)
        a = bytes(rnd.choice(b"abcdefgh ") for _ in range(rnd.randint(12, 40)))
        row, key = lines.keys([a.decode(), edits(rnd, a, e, b"abc").decode()], e)
        assert set(key[row == 0]) & set(key[row == 1])


def test_line_dedup_by_force(spark, edge, edge_texts):
    rnd = random.Random(6)
    base = [bytes(rnd.choice(b"abcdefgh ") for _ in range(rnd.randint(20, 70))) for _ in range(25)]
    texts = list(edge_texts)
    for _ in range(40):
        texts.append("\n".join(edits(rnd, rnd.choice(base), rnd.randint(0, 3), b"abc").decode() for _ in range(rnd.randint(1, 6))))
    where = [(d, k, x) for d, t in enumerate(texts) if t is not None for k, x in enumerate(t.encode().split(b"\n")) if len(x) >= 32]
    parent, find = union_find(len(where))
    for i, a in enumerate(where):
        for j in range(i):
            b = where[j]
            if a[2] == b[2] or (abs(len(a[2]) - len(b[2])) <= 2 and lines.edit_distance(a[2].decode(), b[2].decode(), 2) <= 2):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    gone = {(w[0], w[1]) for i, w in enumerate(where) if find(i) != i}
    df = spark.createDataFrame([(k, t, "kept", k) for k, t in enumerate(texts)], "doc_id long, text string, n_lines string, line long")
    for r in lines.dedup_lines(df).collect():
        t = texts[r["doc_id"]]
        if t is None:
            assert r["text"] is None and r["n_removed"] == 0
            continue
        left = [x for k, x in enumerate(t.split("\n")) if (r["doc_id"], k) not in gone]
        assert r["text"] == "\n".join(left) and r["n_removed"] == len(t.split("\n")) - len(left)


def test_line_dedup_of_nothing(spark, none):
    assert lines.dedup_lines(none).count() == 0
    df = spark.createDataFrame([(None, "x" * 40), (None, "x" * 40)], "doc_id long, text string")
    assert [r["n_removed"] for r in lines.dedup_lines(df).collect()] == [0, 0]


def test_lines_with_changed_words_by_force(spark):
    rnd = random.Random(8)
    letters = [chr(0x4E00 + k) for k in range(400)]
    base = [([f"word{rnd.randint(0, 300)}" for _ in range(n)], " ") for n in (8, 9, 15, 20, 31, 32, 33, 40, 48, 49, 60, 90, 200)] + [([rnd.choice(letters) for _ in range(n)], "") for n in (12, 40)]
    made = []
    for _ in range(160):
        w, gap = rnd.choice(base)
        w = list(w)
        for _ in range(rnd.randint(0, 1 + len(w) // 16)):
            i, op = rnd.randrange(len(w)), rnd.randint(0, 2)
            w[i : i + (op > 0)] = [rnd.choice(letters) if not gap else f"another{rnd.randint(0, 99)}"] if op < 2 else []
        made.append((tuple(w), gap.join(w)))
    made = [m for m in made if len(m[1].encode()) >= 32]
    parent, find = union_find(len(made))
    for i, (a, x) in enumerate(made):
        for j, (b, y) in enumerate(made[:i]):
            n = min(len(a), len(b))
            most = max(1, n // 16) if n >= 8 else 0
            if x == y or (abs(len(a) - len(b)) <= most and distance(a, b) <= most) or (abs(len(x) - len(y)) <= 2 and lines.edit_distance(x, y, 2) <= 2):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    df = spark.createDataFrame([(k, x) for k, (_, x) in enumerate(made)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in lines.dedup_lines(df, rate=16).collect()}
    assert got == {k: int(find(k) != k) for k in range(len(made))}
    assert sum(got.values()) > sum(r["n_removed"] for r in lines.dedup_lines(df).collect())


def test_short_lines_that_hold_a_word_repeat_exactly(spark):
    texts = ["All rights reserved.\n\n---\none", "All rights reserved.\n\n---\ntwo", "All rights reserved!\n§ 1\nДа\none", "Да\n§ 1\n___\n§"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(df, short=True).collect()}
    assert got == {0: texts[0], 1: "\n---\ntwo", 2: "All rights reserved!\n§ 1\nДа", 3: "___\n§"}
    assert queries.QUERIES["op5_segment_line_dedup"](spark, "/root/testdata/sf0.001").agg({"n_removed": "sum"}).first()[0] > lines.dedup_lines(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), rate=16).agg({"n_removed": "sum"}).first()[0]


def test_repeated_rows_keep_one_copy_of_lines_and_bytes(spark):
    rnd = random.Random(13)
    a, b, c, r = ("".join(rnd.choice("abcdefgh ") for _ in range(n)) for n in (400, 150, 300, 120))
    rows = [(1, a, "x"), (1, a, "y"), (2, r + a, None), (2, b, None), (None, a, None), (3, c + "\n" + c, None), (3, c, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, doc string")
    got = sorted((str(x[0]), x[1], x[2]) for x in suffixes.remove_repeats(df).collect())
    assert got == [("1", 400, 0), ("1", 400, 400), ("2", 150, 0), ("2", 520, 400), ("3", 300, 300), ("3", 601, 300), ("None", 400, 0)] or got == [("1", 400, 0), ("1", 400, 400), ("2", 150, 0), ("2", 520, 400), ("3", 300, 0), ("3", 601, 600), ("None", 400, 0)]
    left = sorted((str(x["doc_id"]), x["text"]) for x in lines.dedup_lines(df).collect())
    assert sum(x == ("1", a) for x in left) == 1 and ("1", "") in left and ("None", a) in left
    assert ("2", r + a) in left and ("2", b) in left  # a unique line is never lost
    assert sum(x[1].count(c) for x in left if x[0] == "3") == 1
    assert set(lines.dedup_lines(df).columns) == {"doc_id", "text", "doc", "n_lines", "n_removed"}
    with pytest.raises(TypeError):
        lines.dedup_lines(df.selectExpr("cast(doc_id as string) doc_id", "text"))


def test_recall_of_links_near_the_threshold(spark):
    rnd = random.Random(12)
    texts, want = [], []
    for k in range(150):
        w = [f"w{rnd.randint(0, 10**6)}" for _ in range(90)]
        v = list(w)
        for i in rnd.sample(range(90), 4):  # 2-word shingles: 81 of 97 shared at least
            v[i] = f"z{rnd.randint(0, 10**6)}"
        texts += [" ".join(w), " ".join(v)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    force = near_by_force(texts, 2, 80)
    got = [tuple(r) for r in minhash.near_duplicates(df, words=2).orderBy("doc_id").collect()]
    links = lambda rows: sum(c != d for d, _, c, _ in rows)
    assert links(force) > 100 and got == force


def test_hot_bucket_of_apart_lines_loses_no_link(spark):
    """A phrase that a family of lines shares, of which few are linked: rounds of leaders and the last comparison."""
    rnd = random.Random(21)
    head = " ".join(f"same{k}" for k in range(14))
    made = []
    for k in range(60):
        tail = [f"t{rnd.randint(0, 10**6)}" for _ in range(6)]
        made.append(head + " " + " ".join(tail))
        if k % 3 == 0:
            tail[rnd.randrange(6)] = "other"
            made.append(head + " " + " ".join(tail))
    rnd.shuffle(made)
    parent, find = union_find(len(made))
    for i, a in enumerate(made):
        for j in range(i):
            if lines.linked(a.encode(), made[j].encode(), 2, 16):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in lines.dedup_lines(df, rate=16).collect()}
    assert got == {k: int(find(k) != k) for k in range(len(made))} and sum(got.values()) == 20


@pytest.mark.parametrize("direct", [-1, linking.DIRECT])
def test_open_buckets_walk_new_links_only(spark, monkeypatch, direct):
    """With rounds of leaders or without, components are not made anew from all labels, and no link is lost."""
    rnd = random.Random(22)
    made = []
    for k in range(50):
        head = " ".join(f"same{i}" for i in range(14)) if k % 2 else " ".join(f"h{k}x{i}" for i in range(14))
        tail = [f"t{rnd.randint(0, 10**6)}" for _ in range(6)]
        made.append(head + " " + " ".join(tail))
        for _ in range(k % 3):
            tail[rnd.randrange(6)] = f"o{rnd.randint(0, 10**6)}"
            made.append(head + " " + " ".join(tail))
    rnd.shuffle(made)
    parent, find = union_find(len(made))
    for i, a in enumerate(made):
        for j in range(i):
            if lines.linked(a.encode(), made[j].encode(), 2, 16):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    walked, mixed, make, write = [], [], linking.components, linking.materialize
    monkeypatch.setattr(linking, "components", lambda edges: walked.append(edges.count()) or make(edges))
    monkeypatch.setattr(linking, "materialize", lambda df, name="t", drop=(): mixed.append(name) or write(df, name, drop))
    monkeypatch.setattr(linking, "DIRECT", direct)
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in lines.dedup_lines(df, rate=16).collect()}
    assert got == {k: int(find(k) != k) for k in range(len(made))} and sum(got.values()) > 40
    assert mixed.count("mixed") == (1 if direct > 0 else 2)
    assert len(walked) == 1 + mixed.count("mixed") and walked[0] > 5 * sum(walked[1:])


def test_links_join_labels(spark):
    rnd = random.Random(3)
    parent, find = union_find(200)

    def join(u, v):
        x, y = find(u), find(v)
        parent[max(x, y)] = min(x, y)

    old = [(rnd.randrange(120), rnd.randrange(120)) for _ in range(60)]
    for u, v in old:
        join(u, v)
    label = linking.components(spark.createDataFrame(old, "u long, v long"))
    new = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(40)]
    for u, v in new:
        join(u, v)
    got = [tuple(r) for r in linking._joined(label, spark.createDataFrame(new, "u long, v long")).orderBy("id").collect()]
    assert got == [(k, find(k)) for k in sorted({x for pair in old + new if pair[0] != pair[1] for x in pair})]


def test_words_replaced_in_place_need_no_table(monkeypatch):
    a = [f"w{k}" for k in range(48)]
    b = ["other" if k in (3, 20, 40) else w for k, w in enumerate(a)]
    c = ["other" if k in (3, 20, 30, 40) else w for k, w in enumerate(a)]
    x, y, z = (" ".join(w).encode() for w in (a, b, c))
    assert lines.linked(x, y, 2, 16) and not lines.linked(x, z, 2, 16) and lines.linked(x, b"new " + x, 2, 16)
    monkeypatch.setattr(lines, "edit_distance", None)
    assert lines.linked(x, y, 2, 16)


def test_wanted_lines_come_once(spark):
    """Texts of lines by id: each once, whatever the number of its copies and of the rows that ask for it."""
    made = [f"line {k} that is long enough for edits, {k * 7919}" for k in range(300)] + ["Zeile mit é und 日本語, lang genug für Änderungen"]
    df = spark.createDataFrame([("\n".join(made[k:] + made[:20]),) for k in range(0, 300, 50)] + [(None,), ("",)], "text string").repartition(3)
    ids = dict(zip(made, lines._ids([x.encode() for x in made]).tolist(), strict=True))
    some = made[::3] + made[:9] + made[-1:]
    ask = spark.createDataFrame([(ids[x][0],) for x in some] + [(12345,)], "id long")
    got = lines._texts(df, "text", 32, ask, 16).collect()
    assert sorted((r["id"], r["more"], bytes(r["bytes"]).decode()) for r in got) == sorted((*ids[x], x) for x in set(some))
    assert all(r["n"] == len(bytes(r["bytes"]).decode()) for r in got)
    assert lines._texts(df, "text", 32, ask.limit(0), 16).count() == 0


def test_a_large_group_is_labelled_once_an_id(spark, monkeypatch):
    """Whatever the number of bands that near copies share, the tables that labels are joined to have a row an id."""
    rnd = random.Random(8)
    base = [f"w{k}" for k in range(100)]
    texts = []
    for k in range(60):
        w = list(base)
        for i in rnd.sample(range(100), 1 + k % 6):
            w[i] = f"z{rnd.randint(0, 9999)}"
        texts.append(" ".join(w))
    seen, write = [], linking.materialize

    def counted(df, name="t", drop=()):
        out = write(df, name, drop)
        if name in ("wide", "mixed"):
            seen.append((out.count(), out.select("id").distinct().count()))
        return out

    monkeypatch.setattr(linking, "materialize", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r) for r in minhash.near_duplicates(df, words=2).orderBy("doc_id").collect()]
    assert got == near_by_force(texts, 2, 80)
    assert seen[0][1] > 50 and all(rows == ids for rows, ids in seen)


def test_words_of_lines_are_hashed_as_they_are_split():
    rnd = random.Random(1)
    some = ["".join(rnd.choice("ab c\t\u3000\u00a0日本語éก\x1c\x85 ไทย") for _ in range(rnd.randint(0, 40))).encode() for _ in range(500)]
    have = lines.Letters(some)
    words = [w for x in some for w in lines.line_words(x)]
    assert have.count.tolist() == [len(lines.line_words(x)) for x in some] and have.size.tolist() == [len(x.decode()) for x in some]
    assert len({(w, h) for w, h in zip(words, have.words.tolist(), strict=True)}) == len(set(words)) == len(set(have.words.tolist()))


def test_loser_tree_sorts_and_knows_prefixes():
    rnd = random.Random(5)
    for _ in range(150):
        runs, every, seen = [], [], []
        for k in range(rnd.randint(1, 6)):
            rows = sorted((bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 8))), b"", 0, k, i) for i in range(rnd.randint(1, 7)))
            runs.append(suffixes.Run(suffixes.encode_run(rows)))
            seen.append([r[0] for r in rows])
            every += seen[-1]
        which, at, lcp = suffixes.merge(runs)
        got = [seen[r][i] for r, i in zip(which, at, strict=True)]
        assert got == sorted(every)
        assert all(lcp[i] == suffixes.shared(got[i - 1], got[i]) for i in range(1, len(got)))


def test_repeats_by_force(spark, edge_texts):
    rnd = random.Random(7)
    part = [bytes(rnd.choice(b"abcdef ") for _ in range(rnd.randint(60, 260))).decode() for _ in range(6)]
    texts = list(edge_texts) + ["".join(rnd.choice([*part, "é" * 70, "a" * 150]) for _ in range(rnd.randint(1, 6))) for _ in range(40)]
    seen, want = set(), {}
    for d, t in enumerate(texts):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            w = data[p : p + 100]
            if w in seen:
                gone[p : p + 100] = True
            seen.add(w)
        left = np.frombuffer(data, np.uint8)[~gone].tobytes()
        want[d] = (len(data), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(left).hexdigest(), left)
    got = suffixes.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), keep=True)
    assert {r[0]: (*r[1:5], bytes(r[5])) for r in got.collect()} == want


def test_repeats_in_nothing_and_null_ids(spark, none):
    assert suffixes.remove_repeats(none).count() == 0
    df = spark.createDataFrame([(None, "ab" * 90), (3, "ab" * 90)], "doc_id long, text string")
    assert {(r[0], r[2]) for r in suffixes.remove_repeats(df).collect()} == {(None, 0), (3, 178)}
