"""Token alignment, the filter audit and cost-balanced packing against brute force over whole texts, and on odd input."""

import bisect
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from corvidex.llm import align, audit, balance, queries, units
from corvidex.llm._words import texts_of

DATA = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "  ", "\n", " a", "a ", "a  b", "a   b  ", "foo\n bar", "foo \n\n bar", "x \t y", "tail  ", "Same text.", "Same text.", "naïve café 在 𝄞 ́", "  nbsp   wide   line",
    "▁ mark", "a▁b", "nul \x00 nul", "it's we'll don't '' s's", "<|endoftext|>", "a <|endoftext|> b  <|endoftext|>\n c", "</s> <s> <unk> <0x0A>", "1234567 89,00.5", "x" * 5000, "word " * 4000, "\n" * 300, "á" * 700, "​‍ emoji 👩‍👩‍👧 🏳️‍🌈", "\x1c \x85 \x0b \x0c",
]
PATHS = [queries._vocabulary(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, "s", "clash") for i, t in enumerate(ODD)] + [(None, "no id", None, None, None), (3, "again", "x", "y", "z"), (3, "again", "x", "y", "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_a string, source string, Text2 string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def plain_a():
    return Tokenizer.from_file(PATHS[0])


# units
def test_units_encode_like_whole_texts(plain_a):
    texts = [t or "" for t in ODD]
    ids, counts = balance.encoded(PATHS[0], texts_of(pa.array(texts)))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    for t, own in zip(texts, parts, strict=True):
        assert own.tolist() == plain_a.encode(t, add_special_tokens=False).ids, repr(t)


PARTS = st.sampled_from([*"ab1.,'s\n\t  ▁é在<|>", "<|endoftext|>", " the", "  "])


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.lists(PARTS, max_size=14).map("".join), min_size=1, max_size=4))
def test_units_encode_like_whole_texts_drawn(plain_a, texts):
    ids, counts = balance.encoded(PATHS[0], texts_of(pa.array(texts)))
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [plain_a.encode(t, add_special_tokens=False).ids for t in texts]


def test_known_forgets_and_stays_right():
    seen = Counter()

    def learn(new):
        seen.update(new)
        return [(np.array([len(u) for u in new for _ in range(2)]), np.full(len(new), 2))], new

    known = units.Known(learn, (np.int64,), most=50)
    rng = random.Random(4)
    for _ in range(60):
        own = list({f"{rng.randrange(200) ** 2}" for _ in range(20)})
        rows = known.rows(own)
        assert [known.objects[r] for r in rows] == own and len(known.at) <= 50
        for r, u in zip(rows, own, strict=True):
            assert known.flat[0][known.starts[0][r] : known.starts[0][r + 1]].tolist() == [len(u)] * 2
    assert max(seen.values()) > 1


# 11
def aligned_by_hand(texts: dict):
    """{key: (n_a, n_b, groups, links)} by tokens of whole texts and sets of byte offsets."""
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=PATHS[1])
    letters = {c: bytes([i]) for i, c in units.byte_letters().items()}
    out = {}
    for key, text in texts.items():
        out[key] = None
        if not text:
            continue
        whole = (" " + text).encode()
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ba = [b"".join(letters[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if b"".join(ba) != whole or b"".join(bb) != whole:
            continue
        ea, eb = list(itertools.accumulate(map(len, ba))), list(itertools.accumulate(map(len, bb)))
        both = set(ea) & set(eb)
        groups, ga, gb = [], defaultdict(list), defaultdict(list)
        ends = sorted(both)
        for e, i, held in [(e, i, ga) for e, i in zip(ea, ia, strict=True)] + [(e, i, gb) for e, i in zip(eb, ib, strict=True)]:
            held[ends[bisect.bisect_left(ends, e)]].append(i)
        groups = [f"{','.join(map(str, ga[e]))}|{','.join(map(str, gb[e]))}" for e in ends]
        out[key] = len(ia), len(ib), ";".join(groups), [(ga[e][-1], gb[e][-1]) for e in ends]
    return out


def check_alignment(rows, texts):
    by_hand = aligned_by_hand(texts)
    count = Counter(p for v in by_hand.values() if v for p in v[3])
    highest = defaultdict(int)
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    assert len(rows) == len(texts)
    got = Counter((r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in rows)
    want = Counter()
    for v in by_hand.values():
        if v is None:
            want[0, 0, 0, 0, 0, 0, ""] += 1
        else:
            want[v[0], v[1], len(v[3]), len(v[3]), sum(count[p] == highest[p[1]] for p in v[3]), sum(count[p] for p in v[3]), hashlib.sha256(v[2].encode()).hexdigest()] += 1
    assert got == want


def test_alignment_against_whole_texts(spark, docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = queries.op11_token_alignment(spark, DATA).collect()
    check_alignment(rows, texts)
    assert {r["doc_id"] for r in rows} == set(texts)


def test_alignment_of_odd_texts(odd):
    texts = dict(enumerate([r["text"] for r in odd.collect()]))
    check_alignment(align.align_tokens(odd, *PATHS).collect(), texts)
    # the join that takes over beyond the bound gives the same
    check_alignment(align.align_tokens(odd, *PATHS, most_pairs=3).collect(), texts)
    assert align.align_tokens(odd.where("false"), *PATHS).count() == 0
    assert align.align_tokens(odd.where("false"), *PATHS, most_pairs=-1).count() == 0


def test_alignment_of_a_long_text(spark):
    long = "Ein langer Satz, noch ein Wort.\n" * 90_000 + "z" * 2000
    rows = align.align_tokens(spark.createDataFrame([(1, long), (2, "kurz")], "doc_id long, text string"), *PATHS).collect()
    check_alignment(rows, {1: long, 2: "kurz"})


# 12
def audited_by_hand(rows, marks):
    """{(part, order, step): counts} by running every order over the documents."""
    docs = []
    smallest: dict = {}
    for i, text, _ in rows:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    for i, text, source in rows:
        t = text or ""
        w = [x for x in re.split("[\x20\x09-\x0d]+", t) if x]
        copy = i is not None and i > smallest[t]
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": bool(set(t) & set("#$%&*|")), "E": copy}
        good, toxic = (any(m[0] == i and m[k] == 1 for m in marks if i is not None) for k in (1, 2))
        docs.append((source or "", {f for f in fails if fails[f]}, good, toxic))
    out: dict = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        total: Counter = Counter()
        for order in itertools.permutations("ABCDE"):
            alive = own
            for k, f in enumerate(order):
                gone = [d for d in alive if f in d[1]]
                alive = [d for d in alive if f not in d[1]]
                total[f] += len(gone)
                failing = sum(f in d[1] for d in own)
                out[part, "".join(order), k + 1] = [len(alive), len(gone), failing - len(gone), sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(total[order[k - 1]])
    return {k: tuple(v) for k, v in out.items()}


def check_audit(got, rows, marks):
    want = audited_by_hand(rows, marks)
    have = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in got}
    assert len(got) == len(have) and have == want


def test_audit_against_every_order(spark):
    rng = random.Random(6)
    words = ["alpha", "beta", "GAMMA", "delta", "#eps", "zeta", "eta", "theta"] + [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words[: rng.choice([8, 68])], k=rng.choice([3, 49, 50, 70]))) for _ in range(60)]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in range(150)] + [(None, texts[0], "a"), (7, texts[1], "b"), (7, texts[1], "b"), (200, None, "c"), (201, "", "c"), (202, None, "c")]
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in rng.sample(range(160), 80)] + [(7, 1, 0), (7, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, digest string, good int")
    labels = spark.createDataFrame([(*m, "x") for m in marks], "doc_id long, quality int, toxic int, id string")
    check_audit(audit.audit(audit.flagged(docs, labels)).collect(), rows, marks)
    total = audit.audit(audit.flagged(docs, labels), overall=True).where("part IS NULL").drop("part").withColumn("part", F.lit("")).collect()
    check_audit(total, [(i, t, None) for i, t, _ in rows], marks)
    assert audit.audit(audit.flagged(docs.where("false"), labels)).count() == 0
    check_audit(audit.audit(audit.flagged(docs, labels.where("false"))).collect(), rows, [])


def test_audit_of_long_and_odd_texts(odd, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in odd.collect()]
    long = [(900, "Long word " * 1_000_000, "L"), (901, "Long word " * 1_000_000, "L")]
    docs = odd.select("doc_id", "text", "source").unionByName(spark.createDataFrame(long, "doc_id long, text string, source string"))
    check_audit(audit.audit(audit.flagged(docs, labels)).collect(), rows + long, [])


# 13
def check_balanced(rows, texts: list, plain, capacity=2048):
    """``texts``: (doc_id, text) of each row.  Every id in one piece, sequences gapless and full or a power of two."""
    want: dict = defaultdict(Counter)
    for i, t in texts:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want[i][ids.tobytes()] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(want)
    for i, own in by_doc.items():
        held = Counter()
        # repeated ids: the pieces of all rows of the id, as a multiset of (start, length, crc)
        total = sum(len(ids) // 4 * n for ids, n in want[i].items())
        assert sum(r["length"] for r in own) == total
        if len(want[i]) == 1:
            ids, n = next(iter(want[i].items()))
            ids = np.frombuffer(ids, "<u4")
            for r in own:
                assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]]) and r["length"] > 0
                held.update(range(r["start"], r["start"] + r["length"]))
            assert held == Counter({k: n for k in range(len(ids))})
    padding = 0
    for own in by_sequence.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert padding == 0
    return by_sequence


def test_balanced_packing_of_the_documents(spark, docs, plain_a):
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check_balanced(queries.op13_cost_packing(spark, DATA).collect(), texts, plain_a)


def test_balanced_packing_of_odd_texts(odd, plain_a, spark):
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    rows = balance.pack_balanced(odd, PATHS[0], with_ids=True).collect()
    check_balanced(rows, texts, plain_a)
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4")) and r["cost"] == r["length"] + r["length"] ** 2 / 1024
    # windows smaller than a sequence, and a small capacity
    check_balanced(balance.pack_balanced(odd, PATHS[0], capacity=64, window=16).collect(), texts, plain_a, 64)
    assert balance.pack_balanced(odd.where("false"), PATHS[0]).count() == 0
    long = "Ein langer Satz, noch ein Wort.\n" * 320_000
    check_balanced(balance.pack_balanced(spark.createDataFrame([(1, long), (2, "kurz")], "doc_id long, text string"), PATHS[0]).collect(), [(1, long), (2, "kurz")], plain_a)


def test_costs_are_balanced():
    """Against the plain greedy rule, and closer together than by first fit."""
    rng = random.Random(2)
    sizes = [min(2047, int(rng.expovariate(1 / 400)) + 1) for _ in range(900)]
    window = balance.Window(2048, 1 / 1024, 0)
    for i, n in enumerate(sizes):
        window.add(i, 0, np.full(n, i, np.uint32))
    got = list(window.full())
    bins = [[0, 0.0] for _ in range(sum(sizes) // 2048)]
    todo, want = sorted(enumerate(sizes), key=lambda x: -x[1]), []
    for i, n in todo:
        start = 0
        while n and any(b[0] < 2048 for b in bins):
            fit = [k for k, b in enumerate(bins) if 2048 - b[0] >= n] or [k for k, b in enumerate(bins) if b[0] < 2048]
            k = min(fit, key=lambda k: (bins[k][1], k))
            m = min(n, 2048 - bins[k][0])
            want.append((i, start, m, k, bins[k][0]))
            bins[k][0] += m
            bins[k][1] += m + m * m / 1024
            start, n = start + m, n - m
    assert [(d, s, len(ids), q, o) for d, s, ids, q, o in got] == want
    cost = defaultdict(float)
    for _, _, ids, q, _ in got:
        cost[q] += window.cost(len(ids))
    first = defaultdict(float)  # the same documents, each to the first sequence with room
    room = [2048] * len(bins)
    for _, n in todo:
        while n and any(room):
            k = next((k for k, r in enumerate(room) if r >= n), None)
            k = next(k for k, r in enumerate(room) if r) if k is None else k
            m = min(n, room[k])
            first[k] += m + m * m / 1024
            room[k], n = room[k] - m, n - m
    spread = lambda c: np.std(list(c.values()))
    assert spread(cost) < 0.8 * spread(first)
