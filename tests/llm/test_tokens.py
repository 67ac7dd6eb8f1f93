"""Token shards, collocations and tokenizer alignment against brute force, with odd texts, ties, repeated rows and clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from checks.compare import compare, connect
from reshard.llm import quotient_filter as qf
from reshard.llm.collocations import collocations
from reshard.llm.oracles import ORACLES
from reshard.llm.queries import QUERIES
from reshard.llm.token_alignment import _byte_of, align_documents, link_quality, shown_pair, vocabulary_size
from reshard.llm.token_shards import Body, compress, expand, make_body, read_documents, read_range, rule_lengths, write_token_shards
from reshard.llm.tokens import WordIds, bpe_tokenizer

WORDS = tokenizers.path("word_bpe_49k.json")
BYTES, PIECES = tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model")
CLASHING = ["id", "row", "sum", "part", "shard", "start", "body", "block", "words", "n", "a", "l", "r", "rank", "pairs", "links", "pair", "link"]
# Characters at which tokenizers, white space and normal forms differ.
ODD = [
    *"abAZz'.,<|>!?-_\"$&*#é ßΣσςİıﬁñ日本5٣²½", "́", "​", "\x85", "\xa0", " ", "　", " ", "▁", "﻿", "\x1c", "\x1f", "\x00",
    *"\t\n\r\v\f", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<s>", "</s>", "<0x41>", "'s", "'LL", "'re", "  ", " \n", "\n ", " ", " ",
]


def odd_texts(seed, count, length=40):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(length))) for _ in range(count)]


def documents():
    rnd = random.Random(9)
    prose = " ".join(f"w{rnd.randrange(40)}" + rnd.choice(["", "", ".", ",", "\n"]) for _ in range(400))
    texts = [prose, prose, prose.upper(), None, "", " ", "\n \t", "One", " two  spaces ", "naïve café,naïve café", "=" * 5000, "x" * 3000]
    texts += odd_texts(3, 120) + [" ".join(odd_texts(4, 2000)), " ".join(f"v{rnd.randrange(3000)}" for _ in range(30_000))]
    rows = [(500 - 3 * i, t, [None, "de", "en", "und"][i % 4]) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[0], (rows[0][0], "other text", "en"), (None, prose, "en"), (None, None, None), (None, "", "de")]


ROWS = documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string").repartition(5).withColumns({c: F.lit(f"{c}!") for c in CLASHING})


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("doc_id = -1")


@pytest.fixture(scope="module")
def given(spark, sf):
    return [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


# Word by word


@pytest.mark.parametrize("seed", range(6))
def test_ids_word_by_word_are_those_of_the_text(seed):
    tokenizer = bpe_tokenizer(open(WORDS, "rb").read())
    by_word, whole = WordIds(tokenizer, True), WordIds(tokenizer, False)
    for part in range(4):
        texts = pa.array([*odd_texts(100 * seed + part, 150), None, ""])
        (ids, sizes), (wanted, lengths) = by_word(texts), whole(texts)
        assert sizes.tolist() == lengths.tolist() and ids.tolist() == wanted.tolist()


# Grammar


@pytest.mark.parametrize("seed", range(40))
def test_grammar_round_trip(seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, rng.integers(1, 7), rng.integers(0, 600)).astype(np.uint32)
    if seed % 3 == 0:
        ids = np.tile(ids[:20], 30)
    ends = np.append(np.sort(rng.integers(0, len(ids) + 1, 5)), len(ids))
    least = int(rng.integers(2, 9))
    first, rules, symbols = compress(ids, least)
    assert expand(first, rules, rule_lengths(first, rules), symbols).tolist() == ids.tolist()
    # A rule refers to earlier symbols only.
    assert all(max(r) < first + i for i, r in enumerate(rules.tolist()))
    body = Body(make_body(ids, ends, least))
    assert body.ids().tolist() == ids.tolist() and body.ends.tolist() == ends.tolist()
    for _ in range(10):
        a, z = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
        assert body.ids(a, z).tolist() == ids[a:z].tolist()
    assert body.document(2).tolist() == ids[ends[1] : ends[2]].tolist()


def test_grammar_shortens_what_repeats():
    ids = np.tile(np.arange(100, dtype=np.uint32), 500)
    assert len(make_body(ids, np.array([len(ids)]))) * 20 < 4 * len(ids)
    with pytest.raises(ValueError):
        Body(b"x" * 100)


def token_rows(rows):
    """(doc_id, start, n_tokens, crc32) in the order of ids, NULL first; rows that share an id are ordered by text somehow."""
    tokenizer = Tokenizer.from_file(WORDS)
    out = defaultdict(list)
    for doc, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out[doc].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


@pytest.mark.parametrize("shard_ids", [1, 700, 1 << 20])
def test_token_shards(spark, docs, tmp_path, shard_ids):
    path = str(tmp_path / "shards")
    write_token_shards(docs, path, WORDS, end_id=1, by_word=True, shard_ids=shard_ids)
    got = read_documents(spark, path).orderBy("start").collect()
    wanted = token_rows(ROWS)
    assert [r["doc_id"] for r in got] == sorted((d for d, _, _ in ROWS), key=lambda d: (d is not None, d))
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    found = defaultdict(list)
    for r in got:
        found[r["doc_id"]].append((r["n_tokens"], r["ids_crc32"]))
    assert {d: sorted(v) for d, v in found.items()} == {d: sorted(v) for d, v in wanted.items()}
    whole = [i for r in got for i in r["ids"]]
    for a, z in ((0, 3), (500, 1500), (len(whole) - 2, len(whole) + 5), (7, 7)):
        assert [r["id"] for r in read_range(spark, path, a, z).orderBy("at").collect()] == whole[a:z]
    index = spark.read.parquet(f"{path}/index").orderBy("start").collect()
    if shard_ids == 700:
        assert len(index) > 8 and all(r["n_ids"] >= 700 or r["part"] != n["part"] for r, n in zip(index, index[1:]))


def test_no_documents_make_no_shards(spark, nothing, tmp_path):
    write_token_shards(nothing, str(tmp_path / "s"), WORDS, end_id=1, by_word=True)
    assert read_documents(spark, str(tmp_path / "s")).count() == 0 == read_range(spark, str(tmp_path / "s"), 0, 9).count()


def test_token_query(spark, sf, given):
    wanted, start = {}, 0
    for doc, values in sorted(token_rows(given).items()):
        wanted[doc] = (start, *values[0])
        start += values[0][0]
    rows = QUERIES["op11_token_output"](spark, sf)
    assert rows.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    assert {r["doc_id"]: tuple(r)[1:] for r in rows.collect()} == wanted


# Quotient filters


@pytest.mark.parametrize("words, bits", [(2, 1), (2, 3), (3, 11), (4, 16), (5, 12), (5, 13), (5, 25)])
def test_quotient_filters_lose_nothing(words, bits):
    rng = np.random.default_rng(words * bits)
    shape, known = qf.Shape(words, bits), min(2, (words * bits + 1) // 2)
    ids = rng.integers(0, min(1 << bits, 9), 4000).astype(np.int32)
    if bits > 4:
        ids[rng.integers(0, 4000, 200)] = (1 << bits) - 1
    starts = np.arange(len(ids) - words + 1)
    wanted = Counter(tuple(ids[s : s + words].tolist()) for s in starts)
    high, low = shape.packed(ids, starts)
    assert [tuple(r) for r in shape.words_of(high, low).tolist()] == [tuple(ids[s : s + words].tolist()) for s in starts]
    filters = defaultdict(list)
    for half in (slice(0, 1500), slice(1500, None)):
        entries = qf.counted(high[half], low[half], shape)
        cut = (entries[0] >> np.uint64(shape.left - known)).astype(int)
        for c in set(cut.tolist()):
            filters[c].append(qf.to_bytes(*(side[cut == c] for side in entries), shape, known))
    found = Counter()
    for c, bodies in filters.items():
        h, lo, n = qf.merged(bodies, shape, known, c)
        found.update(dict(zip((tuple(r) for r in shape.words_of(h, lo).tolist()), n.tolist())))
    assert found == wanted


def test_counters_of_more_than_a_byte():
    shape = qf.Shape(2, 4)
    high, low = np.array([1, 2, 3], np.uint64), np.array([5, 0, 15], np.uint64)
    counts = np.array([254, 255, 10**12])
    back = qf.from_bytes(qf.to_bytes(high, low, counts, shape, 0), shape, 0, 0)
    assert [side.tolist() for side in back] == [high.tolist(), low.tolist(), counts.tolist()]


# Collocations


def brute_collocations(rows, least, most, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, most + 1):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        names = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        hidden = {q[i:j] for q, a in names.items() for i in range(len(q)) for j in range(i + 1, len(q) + 1) if j - i < len(q) and 100 * a >= 100 * counts[q[i:j]]}
        found = []
        for p, a in names.items():
            if p not in hidden:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.mark.parametrize("least, most, top, map_bits", [(2, 5, 2000, 27), (5, 4, 7, 7), (100, 5, 2000, 27), (1, 3, 50, 12)])
def test_collocations(docs, least, most, top, map_bits):
    """A tiny map lets nearly every sequence through: the result is the same."""
    got = collocations(docs, least=least, most_words=most, top=top, map_bits=map_bits)
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(ROWS, least, most, top)


def test_no_phrases(nothing):
    assert collocations(nothing).count() == 0


def test_collocations_query(spark, sf):
    assert compare(QUERIES["op12_collocations"](spark, sf), connect(sf), ORACLES["op12_collocations"]) is None


# Alignment


def brute_alignment(rows):
    first, second = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    first.encode_special_tokens = True
    byte_of, entries = _byte_of(), {i: e for e, i in first.get_vocab().items()}
    docs, counts = [], Counter()
    for doc, text, _ in rows:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        a_parts = [bytes(byte_of[c] for c in entries[i]) for i in a]
        pieces = [second.id_to_piece(i) for i in b]
        b_parts = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) and second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_parts) != whole or b"".join(b_parts) != whole:
            docs.append((doc, 0, 0, [], []))
            continue
        a_ends, b_ends = np.cumsum([len(p) for p in a_parts]).tolist(), np.cumsum([len(p) for p in b_parts]).tolist()
        groups, i, j = [], 0, 0
        for end in sorted(set(a_ends) & set(b_ends)):
            x, y = a_ends.index(end, i) + 1, b_ends.index(end, j) + 1
            groups.append((a[i:x], b[j:y]))
            i, j = x, y
        links = Counter((x, y) for p, q in groups for x in p for y in q)
        counts.update(set(links))
        docs.append((doc, len(a), len(b), groups, links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for doc, n_a, n_b, groups, links in docs:
        shown = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        digest = hashlib.sha256(shown.encode()).hexdigest() if n_a else ""
        links = dict(links)
        out.append((
            doc, n_a, n_b, len(groups), sum(links.values()), sum(n for p, n in links.items() if counts[p] == best[p[0]]),
            sum(n * counts[p] for p, n in links.items()), digest,
        ))
    return Counter(out)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("frequent", [1 << 19, 300, 0])
def test_alignment(docs, frequent):
    """Frequent pairs broadcast and all others by shuffle, in any proportion: the same numbers."""
    rows = align_documents(docs, BYTES, PIECES, with_groups=True)
    got = link_quality(rows, vocabulary_size(PIECES), ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"], frequent)
    assert Counter(tuple(r) for r in got.select(COLUMNS).collect()) == brute_alignment(ROWS)
    shown = [r["groups"] for r in rows.where("n_a > 0").collect()]
    assert all(re.fullmatch(r"\d+(,\d+)*\|\d+(,\d+)*(;\d+(,\d+)*\|\d+(,\d+)*)*", s) for s in shown)
    pair = rows.where("n_a > 0").select(shown_pair(F.col("pairs")[0], 32000).alias("p")).first()["p"]
    assert 0 <= pair["a"] < 50257 and 0 <= pair["b"] < 32000


def test_nothing_to_align(nothing):
    rows = align_documents(nothing, BYTES, PIECES)
    assert link_quality(rows, 32000, ["doc_id"]).count() == 0


def test_alignment_query(spark, sf, given):
    rows = QUERIES["op13_tokenizer_alignment"](spark, sf)
    assert Counter(tuple(r) for r in rows.select(COLUMNS).collect()) == brute_alignment(given)
