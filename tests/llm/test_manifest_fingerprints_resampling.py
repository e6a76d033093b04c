"""Merkle manifest, document fingerprints and importance resampling against plain versions of
their definitions, and on nulls, empty and very long texts, ties, repeated rows, empty tables
and extra columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import fingerprints, manifest, resampling

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _tree string, _place string, "
          "digest string, leaf string, root string, score string, _text string, rank string")
LANGS = ["en", "de", None, "fr", "ü", "en", "en"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["Über", "naïve", "日本語", "A-b", "x_y", "3.5"]
    made = []
    for i in range(90):
        n = r.choice([0, 1, 2, 7, 25, 60, 200])
        text = " ".join(r.choice(words) + r.choice(["", "", ".", ",", "\n", "\n\n"]) for _ in range(n))
        made.append((i * 3 % 97, text, LANGS[i % 7], r.choice(["a", "b", None]), len(text)))
    made += [(200, None, "en", None, None), (None, "no id", "de", "a", 5), (201, " \n\t ", None, "a", 4),
             (202, "Long " * 40_000, "lone", "a", 200_000), (203, "x" * 70_000, "en", "b", 70_000),
             made[1], made[1], (made[1][0], "another text of that id", "en", "a", 23),
             (204, "\n\n\n", "en", "a", 3), (205, "", "en", "a", 0)]
    return [(*m, *("clash" for _ in range(8))) for m in made]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- Merkle manifest ------------------------------------------------------------------

def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, text):
    return sha(field(row[0]) + field(row[3]) + field(row[2]) + field(row[4]) + field(text))


def tree_paths(leaves, k):
    """Root, and per leaf the (left, right) digests of every level."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        runs = [level[i:i + k] for i in range(0, len(level), k)]
        for x, path in enumerate(paths):
            run, slot = runs[at[x] // k], at[x] % k
            path.append(("".join(run[:slot]), "".join(run[slot + 1:])))
            at[x] //= k
        level = [sha("".join(run)) for run in runs]
    return level[0], paths


@pytest.mark.parametrize("k", [8, 3, 2])
def test_manifest_equals_a_plain_merkle_tree(docs, rows, k):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree_paths([x[2] for x in sorted(groups[g])], k) for g in names}
    root, upper = tree_paths([trees[g][0] for g in names], k)
    want = Counter()
    for g, above in zip(names, upper):
        for (_, _, own, row), path in zip(sorted(groups[g]), trees[g][1]):
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            low = row[1] and "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1])
            node = leaf(row, low if bad else row[1])
            for left, right in path + above:
                node = sha(left + node + right)
            sibs = "".join(a + b for a, b in path + above)
            want[row[0], own, trees[g][0], root, sha(sibs), node, node == root] += 1
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    got = manifest.manifest(docs, third, low, fanout=k).collect()
    assert Counter(tuple(r) for r in got) == want
    assert {r.verified for r in got} == {True, False}


def test_manifest_of_empty_and_single_rows(spark, docs, empty):
    never = F.lit(False)
    assert manifest.manifest(empty, never, F.col("text")).count() == 0
    one = manifest.manifest(docs.where("doc_id = 200"), never, F.col("text")).collect()
    assert len(one) == 1 and one[0].leaf == one[0].subroot == one[0].root == one[0].folded_root
    assert one[0].verified and one[0].proof_sha256 == sha("")
    with pytest.raises(ValueError):
        manifest.merkle_manifest(docs, "lang", ["doc_id"], "leaf", fanout=1)


def test_manifest_joins_siblings_by_place(spark):
    near = lambda place, n, k: spark.range(1).select(manifest._siblings(
        F.lit(place).cast("long"), F.lit(n), k)).first()[0]
    assert near(6, 9, 2) == [7] and near(7, 9, 2) == [6] and near(8, 9, 2) == []
    assert sorted(near(9, 12, 8)) == [8, 10, 11] and sorted(near(3, 100, 8)) == [0, 1, 2, 4, 5, 6, 7]


# --- document fingerprints --------------------------------------------------------------

def test_cuts_lose_nothing_and_roots_test_equality():
    r = random.Random(5)
    seen = {}
    for _ in range(300):
        text = "".join(r.choice(["a", "Word ", "b. ", "\n", "  ", "\t", "# H\n", "日本", "é", "\r\n", "\x0b", "1.2 X\n"])
                       for _ in range(r.randrange(60)))
        lines = re.findall(r"[^\n]*\n|[^\n]+", text)
        assert "".join(lines) == text and all("".join(fingerprints._pieces(x)) == x for x in lines)
        mark = fingerprints.fingerprint(text)
        assert seen.setdefault(mark.split("/")[0], text) == text
        assert fingerprints.fingerprint(text) == mark
        root, sections = fingerprints.parse(mark)
        assert (root, sections) == (fingerprints.tree(text)[0], fingerprints.tree(text)[1])


def test_edits_are_located_and_leave_other_branches():
    r = random.Random(6)
    lines = [" ".join(r.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(r.randrange(99)) for _ in range(20))
             for _ in range(30)]
    one = "\n".join(lines)
    other = lines.copy()
    other[17] = "quite another line, of a few words only"
    two = "\n".join(other)
    a, b = fingerprints.fingerprint(one), fingerprints.fingerprint(two)
    paragraphs = [p for _, s in fingerprints.parse(a)[1] for p in s]
    where = [(i, j) for i, (_, s) in enumerate(fingerprints.parse(a)[1]) for j in range(len(s))]
    assert len(paragraphs) == 30 and fingerprints.differing_branches(a, b) == [where[17]]
    assert 0.9 < fingerprints.likeness(a, b) < 1 and fingerprints.likeness(a, b) == fingerprints.likeness(b, a)
    assert fingerprints.likeness(a, a) == 1 and fingerprints.differing_branches(a, a) == []
    moved = fingerprints.fingerprint("\n".join([*lines[10:], *lines[:10]]))
    assert fingerprints.likeness(a, moved) > 0.85
    assert fingerprints.likeness(a, fingerprints.fingerprint("something else")) < 0.1
    assert fingerprints.likeness(fingerprints.fingerprint(""), fingerprints.fingerprint("")) == 1
    assert fingerprints.likeness(a, fingerprints.fingerprint("")) == 0


def test_edit_fingerprints_follow_the_next_document(spark, docs, rows, empty):
    got = fingerprints.edit_fingerprints(docs).collect()
    assert len(got) == len(rows)
    marks = {}
    for row in rows:
        marks.setdefault(row[0], set()).add(fingerprints.fingerprint(row[1] or ""))
    texts = {fingerprints.fingerprint(row[1] or ""): row[1] or "" for row in rows}
    ids = sorted({(row[0] is not None, row[0] or 0) for row in rows})
    for r in got:
        assert r.fingerprint in marks[r.doc_id] and r.n_chars == len(texts[r.fingerprint])
        at = ids.index((r.doc_id is not None, r.doc_id or 0))
        after = ids[(at + 1) % len(ids)]
        nexts = marks[after[1] if after[0] else None]
        if len(marks[r.doc_id]) > 1 or Counter(x[0] for x in rows)[r.doc_id] > 1:
            nexts = nexts | marks[r.doc_id]  # rows that repeat the id come first
        text = texts[r.fingerprint]
        half = len(text) // 2
        options = {}
        for mark in nexts:
            changed = text[:len(text) - half] + texts[mark][:half]
            options[hashlib.sha256(changed.encode()).hexdigest()] = (changed, mark)
        assert r.edited_sha256 in options
        changed = options[r.edited_sha256][0]
        assert r.edited_fingerprint == fingerprints.fingerprint(changed)
        assert r.near_edited == fingerprints.likeness(r.fingerprint, r.edited_fingerprint)
        assert any(r.near_next == fingerprints.likeness(r.fingerprint, m) for m in nexts)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert fingerprints.edit_fingerprints(empty).count() == 0
    lone = fingerprints.edit_fingerprints(docs.where("doc_id = 203")).collect()
    assert len(lone) == 1 and lone[0].near_next == 1 and lone[0].n_chars == 70_000


def test_next_rows_do_not_depend_on_the_partitioning(spark, docs):
    unique = docs.where("doc_id > 203 OR doc_id < 90").dropDuplicates(["doc_id"])
    pick = lambda d: sorted((r.doc_id, r.edited_sha256, r.near_next) for r in d.collect())
    unique = spark.createDataFrame(unique.collect(), SCHEMA)
    want = pick(fingerprints.edit_fingerprints(unique.coalesce(1)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        assert pick(fingerprints.edit_fingerprints(unique.repartition(7))) == want
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        assert pick(fingerprints.edit_fingerprints(unique)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# --- importance resampling ------------------------------------------------------------------

def plain_features(text, longest):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("longest, percent", [(1, 10), (3, 50)])
def test_resampling_equals_its_definition(spark, docs, rows, longest, percent):
    aim = ["W1 w2, w3 Über-naïve 日本語", None, "", "w5 w5 w5 w6 3.5", "w59\x00w1"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(aim)], "item_id long, text string")
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    found = [plain_features(r[1], longest) for r in rows]
    s = Counter(bucket(f) for _, fs in found for f in fs)
    t = Counter(bucket(f) for a in aim for f in plain_features(a, longest)[1])
    gain = lambda b: math.floor(1000 * math.log(
        (t[b] + 1) * (sum(s.values()) + 10000) / ((s[b] + 1) * (sum(t.values()) + 10000))))
    scored = []
    for row, (words, features) in zip(rows, found):
        weight = sum(gain(bucket(f)) for f in features) // len(features) if features else 0
        h = int(sha(f"2024:{'' if row[0] is None else row[0]}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((row[0], len(features), weight, score, len(words)))
    large = sorted((-x[3], x[0] is not None, x[0] or 0) for x in scored if x[4] >= 20)
    drawn = len(large) * percent // 100
    got = resampling.resample(docs, target, longest=longest, percent=percent).collect()
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == Counter(x[:4] for x in scored)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, drawn + 1))
    assert [(-r.score, r.doc_id is not None, r.doc_id or 0) for r in ranked] == large[:drawn]


def test_resampling_of_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(empty, none).count() == 0
    got = resampling.resample(docs, none).collect()
    assert len(got) == docs.count() and any(r["rank"] == 1 for r in got)


def test_scan_emits_whole_overlapping_word_runs():
    words = resampling.plain_words("A  b-C,\tdd\n".encode())
    assert words == b"a b c dd"
    spans = lambda n: [m[0] for m in resampling.scanner(n).finditer(words, overlapped=True)]
    assert spans(1) == [b"a", b"b", b"c", b"dd"] and spans(2) == [b"a b", b"b c", b"c dd"]
    assert spans(4) == [words] and spans(5) == []
