"""Each operator against brute force on documents with NULLs, empty and long texts, ties, repeated rows and odd columns."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import compare, connect
from reshard.llm import jaccard_join, line_dedup, suffix_dedup
from reshard.llm.components import components
from reshard.llm.decontamination import build_index, decontaminate, proximity_matches, test_windows as windows_of, with_rarest_term
from reshard.llm.exact_dedup import exact_groups
from reshard.llm.jaccard_join import derived_overlaps, jaccard_components
from reshard.llm.line_dedup import dedup_lines
from reshard.llm.mixing import deal_blocks, mix, splitting_tree
from reshard.llm.oracles import ORACLES
from reshard.llm.queries import QUERIES
from reshard.llm.sharding import communication_matrix, shuffle_to_shards
from reshard.llm.substring_dedup import remove_repeats
from reshard.llm.suffix_dedup import remove_repeated_bytes, repeats_within

# Names of helper columns of the operators, which must not get in the way.
CLASHING = ["id", "sum", "size", "shard", "slot", "score", "kept", "n_words", "rank", "block", "host", "words", "doc", "n", "row"]
SPACE = " \t\n\v\f\r"


def sentence(rnd, n, words=400):
    return " ".join(f"w{rnd.randrange(words)}" for _ in range(n))


def documents():
    rnd = random.Random(7)
    base, passage = sentence(rnd, 160), sentence(rnd, 70)
    near = base.split()
    texts = [base, base, base.upper(), None, "", " \n\t ", "one", "One", "a b c", passage, "é " * 300, "x\0y " * 150]
    for i in range(30):
        words = list(near)
        for _ in range(rnd.randrange(1, 12)):
            words[rnd.randrange(len(words))] = f"e{rnd.randrange(10_000)}"
        texts.append(" ".join(words))
    for i in range(12):
        texts.append(sentence(rnd, rnd.randrange(20, 90)) + "\n" + passage + "\n" + sentence(rnd, 30) + "\nThe same line, again and again.")
    texts.append(sentence(rnd, 30_000, 5_000) + " " + passage)
    rows = [(1000 - 3 * i, t, [None, "b", "a", "é"][i % 4]) for i, t in enumerate(texts)]
    # Repeated rows, one id with two texts, and rows without id.
    return rows + [rows[0], rows[12], (rows[13][0], passage, "a"), (None, passage, "a"), (None, base, "b"), (None, None, None)]


ROWS = documents()


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, "doc_id bigint, text string, source string").repartition(5)
    return frame.withColumns({c: F.lit(f"{c}!") for c in CLASHING})


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("doc_id = -1")


def split_spaces(text):
    return (text or "").encode().split()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def plain(frame, *names):
    return Counter(tuple(r) for r in frame.select(*names).collect())


@pytest.fixture(scope="module")
def tables(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, tables, name):
    assert compare(QUERIES[name](spark, sf), tables, ORACLES[name]) is None


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("ranges", [1, 40])
def test_exact_groups(docs, nothing, keep, ranges):
    groups = defaultdict(list)
    for i, t, _ in ROWS:
        groups[lower(t)].append(i)
    found = exact_groups(docs, keep=keep, ranges=ranges).collect()
    assert Counter((r["doc_id"], r["text_sha256"]) for r in found) == Counter((i, sha(lower(t).encode())) for i, t, _ in ROWS)
    for text, ids in groups.items():
        mine = [r for r in found if r["text_sha256"] == sha(text.encode())]
        known = [i for i in ids if i is not None]
        best = (min(known) if keep == "smallest" else max(known)) if known else None
        assert {(r["keep_id"], r["group_size"]) for r in mine} == {(best, len(ids))}
        assert [r["doc_id"] for r in mine if r["kept"]] == [best]
    assert exact_groups(nothing).count() == 0


def removed_words(width):
    first = defaultdict(list)
    for i, t, _ in ROWS:
        w = split_spaces(t)
        for p in range(len(w) - width + 1):
            first[tuple(w[p : p + width])].append(i)
    out = []
    for i, t, _ in ROWS:
        w, gone = split_spaces(t), set()
        for p in range(len(w) - width + 1):
            ids = [x for x in first[tuple(w[p : p + width])] if x is not None]
            if ids and (i is None or min(ids) < i):
                gone.update(range(p, p + width))
        out.append((i, len(w), len(gone), sha(b" ".join(x for k, x in enumerate(w) if k not in gone))))
    return Counter(out)


@pytest.mark.parametrize("width", [50, 7])
def test_substring_dedup(docs, nothing, width):
    assert plain(remove_repeats(docs, width, with_text=False), "doc_id", "n_words", "n_removed", "kept_sha256") == removed_words(width)
    assert remove_repeats(nothing, width).count() == 0


def test_substring_spans_and_text(docs):
    for r in remove_repeats(docs).collect():
        assert sum(b - a for a, b in r["spans"]) == r["n_removed"] and sha(r["kept"].encode()) == r["kept_sha256"]


def removed_bytes(width):
    texts = [(t or "").encode() for _, t, _ in ROWS]
    seen = Counter(t[p : p + width] for t in texts for p in range(len(t) - width + 1))
    out = []
    for (i, _, _), t in zip(ROWS, texts):
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - width + 1):
            if seen[t[p : p + width]] > 1:
                gone[p : p + width] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, sha(bytes(x for x, g in zip(t, gone) if not g))))
    return Counter(out)


@pytest.mark.parametrize("width, group", [(400, 1 << 20), (150, 1 << 20), (400, 1000)])
def test_suffix_dedup(docs, nothing, monkeypatch, width, group):
    """With a small bound on groups all of them are compared window by window."""
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", group)
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert plain(remove_repeated_bytes(docs, width, with_bytes=False), *names) == removed_bytes(width)
    assert remove_repeated_bytes(nothing, width).count() == 0


def test_interval_expansion():
    rnd = random.Random(3)
    for _ in range(150):
        width = rnd.choice([1, 3, 8, 20])
        texts = [bytes(rnd.choice(b"\0ab\xff") for _ in range(rnd.randint(0, 60))) for _ in range(rnd.randint(1, 5))]
        seen = Counter(t[p : p + width] for t in texts for p in range(len(t) - width + 1))
        expected = [[p for p in range(len(t) - width + 1) if seen[t[p : p + width]] > 1] for t in texts]
        assert [p.tolist() for p in repeats_within(texts, width)] == expected


ITEM_ROWS = [(1, "W1 w2"), (2, None), (3, ""), (None, "one"), (10, "a, B c!"), (10, "zz")]


def bench_words(text):
    out, word = [], ""
    for c in lower(text) + " ":
        if c.isdigit() and c.isascii() or "a" <= c <= "z" or ord(c) > 127:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def test_decontamination(spark, docs, nothing):
    passage = ROWS[9][1]
    items = spark.createDataFrame([*ITEM_ROWS, (4, passage), (5, " ".join(passage.split()[20:40]))], "item_id bigint, text string")
    windows = set()
    for item, t in [*ITEM_ROWS, (4, passage), (5, " ".join(passage.split()[20:40]))]:
        w = bench_words(t)
        windows |= {("" if item is None else str(item), tuple(w[p : p + 13])) for p in range(max(1, len(w) - 12)) if w}
    lengths, by = {len(w) for _, w in windows}, defaultdict(set)
    for item, w in windows:
        by[w].add(item)
    expected = []
    for i, t, _ in ROWS:
        w, hit, names = bench_words(t), set(), set()
        for n in lengths:
            for p in range(len(w) - n + 1):
                if found := by.get(tuple(w[p : p + n])):
                    hit.update(range(p, p + n))
                    names |= found
        bad = bool(hit) and 20 * len(hit) >= len(w)
        expected.append((i, len(w), len(hit), len(names), sha(",".join(sorted(names)).encode()), bad))
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert plain(decontaminate(docs, items), *names) == Counter(expected)
    clean = decontaminate(docs, items.where("item_id = -1"))
    assert {(r["n_hit"], r["contaminated"]) for r in clean.collect()} == {(0, False)}
    assert decontaminate(nothing, items).count() == 0


def test_proximity(spark):
    texts = spark.createDataFrame([(1, "red fish swims near blue boat"), (2, "red red red blue"), (3, "blue 1 2 3 4 5 6 7 8 red")], "doc_id bigint, text string")
    items = spark.createDataFrame([("q", "blue red")], "item_id string, text string")
    windows = with_rarest_term(windows_of(items), texts)
    index = build_index(texts, windows, 6)
    assert sorted(r["doc"]["id"] for r in proximity_matches(index, windows, 6).collect()) == [1, 2]


def test_mixing(docs, nothing):
    rows = mix(docs).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert r["times"] * r["size"] <= 3 * r["size"] and r["size"] == len(split_spaces(r["doc"]["text"]))
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["times"]
        target[r["source"]] = r["target"]
    assert len(rows) == len(ROWS) and set(sizes) == {None, "a", "b", "é"}
    total = sum(sizes.values())
    assert abs(sum(target.values()) - total) < 1e-6
    # By code point, NULL last: a 5, b 2, é 1, NULL 5; shares are equal per weight where the cap does not bind.
    level = {s: target[s] / w for s, w in {"a": 5, "b": 2, "é": 1, None: 5}.items() if target[s] < 3 * sizes[s]}
    assert max(level.values()) - min(level.values()) < 1e-6
    for s in sizes:
        assert taken[s] <= target[s] + 1e-6 and target[s] - taken[s] < max(len(split_spaces(t)) for _, t, _ in ROWS)
    assert sorted(map(str, rows)) == sorted(map(str, mix(docs.repartition(3)).collect()))
    assert mix(nothing).count() == 0


def test_mixing_fills_behind_a_long_document(spark):
    """The long document comes early in its source's order and is larger than the target."""
    key = lambda i, t: hashlib.md5(f"mix|{i}|{sha_md5(t)}".encode()).hexdigest()
    sha_md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    long = "w " * 8000
    early = next(i for i in range(10_000, 20_000) if key(i, long).startswith("2"))
    rows = [(i, f"w{i} " * 10, "a") for i in range(500)] + [(1000 + i, f"w{i} " * 10, "b") for i in range(700)] + [(early, long, "b")]
    frame = spark.createDataFrame(rows + [(1000, "w0 " * 10, "b")] * 2, "doc_id bigint, text string, source string").repartition(3)
    found = mix(frame).collect()
    for s in ("a", "b"):
        mine = [r for r in found if r["source"] == s]
        whole = int(mine[0]["target"] // mine[0]["source_size"])
        gap = mine[0]["target"] - sum(r["size"] * r["times"] for r in mine)
        assert 0 <= gap < min(r["size"] for r in mine if r["times"] == whole)
    assert [r["times"] for r in found if r["size"] == 8000] == [0]
    assert sorted(map(str, found)) == sorted(map(str, mix(frame.repartition(5)).collect()))


def test_blocks_are_dealt_exactly(docs):
    rows = deal_blocks(mix(docs), shards=3, block_docs=2).collect()
    wanted = Counter(str(r["doc"]) for r in mix(docs).collect() for _ in range(r["times"]))
    assert Counter(str(r["doc"]) for r in rows) == wanted
    for s in range(3):
        slots = [r["slot"] for r in rows if r["shard"] == s]
        assert sorted(slots) == list(range(len(slots)))
    tree = splitting_tree([7, 0, 12, 1], 5, 1)
    assert [sum(leaf[i] for leaf in tree) for i in range(4)] == [7, 0, 12, 1]
    assert sorted(sum(leaf) for leaf in tree) == [4] * 5


def test_sharding(docs, nothing):
    rows = shuffle_to_shards(docs, 4, rows_per_block=7).collect()
    assert Counter(str(r["doc"]) for r in rows) == Counter(str(r) for r in docs.collect())
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(4)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(4):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    assert sorted(map(str, rows)) == sorted(map(str, shuffle_to_shards(docs.repartition(2), 4, rows_per_block=7).collect()))
    assert shuffle_to_shards(nothing).count() == 0


def test_matrix_is_that_of_a_uniform_shuffle():
    """Row and column sums are exact; a cell is distributed as by dealing shuffled cards."""
    cells = Counter()
    for seed in range(4000):
        matrix = communication_matrix([3, 4], 2, seed)
        assert [sum(r) for r in matrix] == [3, 4] and [sum(c) for c in zip(*matrix)] == [4, 3]
        cells[matrix[0][0]] += 1
    expected = {0: 1 / 35, 1: 12 / 35, 2: 18 / 35, 3: 4 / 35}
    assert all(abs(cells[k] / 4000 - p) < 0.03 for k, p in expected.items())


def test_shuffle_is_uniform(spark):
    """Every row is as likely in every shard, and neighbours are not kept together."""
    rows = shuffle_to_shards(spark.range(4000).withColumnRenamed("id", "doc_id"), 4, rows_per_block=500).collect()
    shard = {r["doc"]["doc_id"]: r["shard"] for r in rows}
    together = sum(shard[i] == shard[i + 1] for i in range(3999)) / 3999
    assert abs(together - 0.25) < 0.03


def shingles(text):
    w = lower(text).encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def linked_components():
    sets = [shingles(t) for _, t, _ in ROWS]
    linked = [
        [j for j, b in enumerate(sets) if j != i and a and b and 100 * len(a & b) >= 80 * len(a | b)] for i, a in enumerate(sets)
    ]
    out = []
    for i, (doc_id, _, _) in enumerate(ROWS):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [ROWS[j][0] for j in seen if ROWS[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None, len(linked[i])))
    return Counter(out)


@pytest.mark.parametrize("short, tokens", [(24, 200_000), (2, 200_000), (2, 1000)])
def test_jaccard_components(docs, nothing, monkeypatch, short, tokens):
    """All candidates by pairs; most by blocks; blocks of a few sets."""
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", short)
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", tokens)
    found = plain(jaccard_components(docs), "doc_id", "n_shingles", "component_id", "n_links")
    assert found == linked_components()
    assert jaccard_components(nothing).count() == 0


def test_derived_overlaps():
    rnd = random.Random(4)
    base = rnd.sample(range(10**6), 80)
    sets = [np.unique(np.array(rnd.sample(base, rnd.randrange(0, 80)) + [rnd.randrange(10**6) for _ in range(rnd.randrange(5))], np.int64)) for _ in range(25)]
    for own, found in zip(sets, derived_overlaps(sets, sets[::-1])):
        assert found.tolist() == [len(set(own.tolist()) & set(b.tolist())) for b in sets[::-1]]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)] + [(7, 7), (None, 3), (500, 400)]
    found = components(spark.createDataFrame(edges, "a int, b int")).collect()
    assert {r["node"]: r["root"] for r in found} == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 180)}, 500: 400, 400: 400}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("short", [16, 1])
def test_line_dedup(spark, nothing, monkeypatch, short):
    monkeypatch.setattr(line_dedup, "SHORT_BUCKET", short)
    rnd = random.Random(9)
    line = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(25):
        changed = list(line)
        for _ in range(i % 4):
            changed[rnd.randrange(60)] = f"edit{rnd.randrange(99)}"
        rows.append((100 - i, f"Own line {i} {sentence(rnd, 12)}\n{' '.join(changed)}\n\n--\nThe SAME, line."))
    rows += [rows[3], (None, "the same line"), (7, None), (8, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("id", F.lit("x")).withColumn("line", F.lit("y"))
    norms = {n for _, t in rows for n in (" ".join(bench_words(x)) for x in (t or "").split("\n")) if n}
    words = sorted({w for n in norms for w in n.split()})
    hashed = {r["w"]: r["h"] for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h")).collect()}

    def simhash(norm):
        own = norm.split()
        return sum(1 << b for b in range(64) if 2 * sum((hashed[w] >> b) & 1 for w in own) > len(own))

    bits, root = {n: simhash(n) for n in norms}, {n: n for n in norms}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    listed = sorted(norms)
    for i, a in enumerate(listed):
        for b in listed[i + 1 :]:
            if bin(bits[a] ^ bits[b]).count("1") <= 3 and edit_distance(a, b) <= max(len(a), len(b)) * 15 // 100:
                root[find(a)] = find(b)
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or ""))):
        for at, x in enumerate((t or "").split("\n")):
            if n := " ".join(bench_words(x)):
                first.setdefault(find(n), (i, at))
    expected = []
    for i, t in rows:
        kept = []
        for at, x in enumerate((t or "").split("\n")):
            n = " ".join(bench_words(x))
            if not n or first[find(n)] == (i, at):
                kept.append(x)
        n_lines = len((t or "").split("\n"))
        expected.append((i, n_lines, n_lines - len(kept), sha("\n".join(kept).encode())))
    assert sum(e[2] for e in expected) > 30 and len({find(n) for n in norms}) < len(norms)
    assert plain(dedup_lines(frame), "doc_id", "n_lines", "n_removed", "kept_sha256") == Counter(expected)
    assert dedup_lines(nothing).count() == 0


def near_lines():
    """Base lines of 12, 27 and 50 words with copies in which words or letters are changed."""
    rnd, out = random.Random(12), []
    syllables = [a + b for a in "bcdfglmnprst" for b in "aeiou"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.choice([1, 2, 2, 3, 3, 4])))
    for n, words, letters in [(4, 0, 2), (12, 1, 4), (27, 1, 8), (27, 3, 12), (50, 3, 16)]:
        for _ in range(40):
            base = [word() for _ in range(n)]
            copy = list(base)
            for at in rnd.sample(range(n), words):
                copy[at] = word()
            typed = list(" ".join(base))
            for at in rnd.sample(range(len(typed)), letters):
                typed[at] = rnd.choice("aeiou") if typed[at] != " " else " "
            out += [" ".join(base), " ".join(copy), "".join(typed)]
    return sorted(set(out))


def test_near_lines_are_found(spark):
    """Pairs found, against all pairs that are near by edits alone."""
    norms = near_lines()
    frame = spark.createDataFrame(list(enumerate(norms)), "doc_id bigint, text string").repartition(4)
    numbered = frame.select(F.col("doc_id").alias("i"), F.col("text").alias("t"))
    a, b = numbered.alias("a"), numbered.alias("b")
    most = F.expr("cast(greatest(length(a.t), length(b.t)) * 15 div 100 as int)")
    close = (F.col("a.i") < F.col("b.i")) & (F.abs(F.length("a.t") - F.length("b.t")) <= most)
    true = {tuple(r) for r in a.join(b, close).where(F.expr("levenshtein(a.t, b.t)") <= most).select("a.i", "b.i").collect()}
    lines = line_dedup.lines_of(frame, "doc_id", "text")
    number = {r["line"]: r["id"] for r in lines.collect()}
    root = {number[r["line"]]: r["root"] for r in line_dedup.line_groups(lines, "grams").collect()}
    for n in (4, 12, 27, 50):
        mine = [(i, j) for i, j in true if len(norms[i].split()) == n]
        assert len(mine) >= 30 and sum(root[i] == root[j] for i, j in mine) >= 0.9 * len(mine)
    joined = {x: {x} for x in range(len(norms))}
    for i, j in true:
        if joined[i] is not joined[j]:
            joined[i] |= joined[j]
            joined.update(dict.fromkeys(joined[j], joined[i]))
    for r in set(root.values()):  # nothing is linked that edits do not link
        members = [x for x in root if root[x] == r]
        assert all(joined[x] is joined[members[0]] for x in members)
    removed = {r["doc_id"]: r["n_removed"] for r in dedup_lines(frame, by="grams").collect()}
    assert sum(removed.values()) == len(norms) - len(set(root.values()))
