"""Conversation repair, source divergence and exact deduplication against brute force on small awkward tables."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from pricelens.llm import conversation_repair, divergence, exact_dedup, perfect_hash

SPACE = "\x20\x09-\x0D"
GOAL = re.compile("(s?(ua)+)?")


# conversation repair

def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        role, text = show(role), show(text)
        what = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if what == 1:
            text = ""
        elif what == 2:
            text = re.sub("[.!?]", "", text)
        elif what == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
    return out


def faults(rows):
    """Rows of one conversation in order, with the fault letter of each."""
    body = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), body(r)))
    seen, out = set(), []
    for r in rows:
        if not re.search(f"[^{SPACE}]", r[3]):
            fault = "b"
        elif (r[2], r[3]) in seen:
            fault = "x"
        else:
            fault = "k" if re.search(f"[^{SPACE}]", r[3]) and re.sub(f"[{SPACE}]+$", "", r[3])[-1] in ".!?" else "t"
        seen.add((r[2], r[3]))
        out.append((r, fault))
    return out


def every_way(rows):
    """All repairs of a few rows with at most two turns put in at a place."""
    options = []
    for (_, _, role, _), fault in rows:
        more = 5 if fault == "t" else 0
        keep = [] if fault in "bx" else [("K", more, role[:1]), ("R", 1 + more, "u"), ("R", 1 + more, "a")]
        options.append([("D", 2, ""), *keep])
    gap = [("", 0, ""), ("I", 5, "u"), ("I", 5, "a"), ("II", 10, "ua"), ("II", 10, "au")]
    steps = [gap]
    for o in options:
        steps += [o, gap]
    best = (10**9, "")
    for way in itertools.product(*steps):
        cost = sum(c for _, c, _ in way)
        if cost <= best[0] and GOAL.fullmatch("".join(i for *_, i in way)):
            best = min(best, (cost, "".join(e for e, *_ in way)))
    return best


def cheapest(rows):
    """Uniform-cost search over (cost, edits)."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, closed = [(0, "", 0, "")], set()
    while heap:
        cost, edits, i, last = heapq.heappop(heap)
        if (i, last) in closed:
            continue
        closed.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, edits
        for role in set(follows[last]) & set("ua"):
            heapq.heappush(heap, (cost + 5, edits + "I", i, role))
        if i < len(rows):
            (_, _, role, _), fault = rows[i]
            heapq.heappush(heap, (cost + 2, edits + "D", i + 1, last))
            if fault in "kt":
                more = 5 if fault == "t" else 0
                if role[:1] and role[0] in follows[last]:
                    heapq.heappush(heap, (cost + more, edits + "K", i + 1, role[0]))
                for to in set(follows[last]) & set("ua"):
                    heapq.heappush(heap, (cost + 1 + more, edits + "R", i + 1, to))


def apply(rows, audit):
    out, last, i = [], "", 0
    for edit in audit:
        needed = "assistant" if last == "u" else "user"
        if edit == "I":
            out.append((needed, ""))
        else:
            (_, _, role, text), _ = rows[i]
            i += 1
            if edit == "D":
                continue
            out.append((role if edit == "K" else needed, text))
        last = out[-1][0][0]
    assert i == len(rows) and GOAL.fullmatch("".join(r[0] for r, _ in out))
    return out


def conversations():
    rng = random.Random(11)
    rows = []
    for conv in range(90):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = rng.choice(["Hello there.", "Yes!", "a word", "cut off in the", "Why?  \n", " \t", "", None, "Done. "]) if rng.random() < 0.6 else f"Reply {rng.random()}."
            rows.append((conv, turn if rng.random() < 0.97 else rng.choice([None, 3, turn + 4]), role, text))
    rows += [(None, t, r, "Fine.") for t, r in ((0, "user"), (1, "assistant"), (None, "assistant"), (1, "assistant"))]
    rows += [(200, t, ("user", "assistant")[t % 2], f"Turn {t}" + ("." if t % 7 else "")) for t in range(400)]
    rows += [(201, None, None, None)] * 3 + [(202, 5, "user", "word " * 20000 + "."), (202, 6, "assistant", "One 😀 answer。.")] * 2
    return rows


def test_repair_equals_brute_force(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "conv_id long, turn long, role string, text string, n long, place long, letter string")
    after = defaultdict(list)
    for r in damage(rows):
        after[r[0]].append(r)
    want, turns = {}, Counter()
    for conv in {r[0] for r in rows}:
        mine = faults(after[conv])
        cost, audit = cheapest(mine)
        if len(mine) <= 3:
            assert (cost, audit) == every_way(mine)
        numbers = [r[1] for r, _ in mine if r[1] is not None]
        initials = [r[2][:1] for r, _ in mine]
        kept = apply(mine, audit)
        kinds = Counter(f for _, f in mine)
        want[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, kinds["b"], kinds["x"], kinds["t"],
                      sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                      hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
        turns.update((conv, i, r, t) for i, (r, t) in enumerate(kept))
    damaged = conversation_repair.damaged(df)
    got = conversation_repair.repaired(damaged).collect()
    assert len(got) == len(want)
    assert {r.conv_id: tuple(r)[1:] for r in got} == want
    assert Counter((r.conv_id, r.place, r.role, r.text) for r in conversation_repair.repaired_turns(damaged).collect()) == turns
    assert conversation_repair.repaired(conversation_repair.damaged(df.limit(0))).count() == 0


def test_search_of_a_long_conversation():
    rng = random.Random(5)
    letters = "".join(rng.choice("uuuaaas?") + rng.choice("kkkkkkkkbxtt") for _ in range(3000))
    rows = [((0, 0, letters[i], ""), letters[i + 1]) for i in range(0, len(letters), 2)]
    assert conversation_repair.search(letters) == cheapest(rows)
    assert conversation_repair.search("") == (0, "") and conversation_repair.search("ub") == (2, "D")


# source divergence

def brute_divergence(rows, min_docs, top):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(low))) for lang, source, text in rows]
    df = Counter((lang, t) for lang, _, ts in docs for t in set(ts))
    kept = defaultdict(list)
    for (lang, t), n in df.items():
        if n >= min_docs:
            kept[lang].append(t)
    count = Counter()
    for lang, source, ts in docs:
        for t in ts:
            if df[lang, t] >= min_docs:
                count[lang, source, t] += 1
                count[lang, None, t] += 1
    groups = {(lang, source) for lang, source, _ in docs}
    p = {}
    for lang, source in groups | {(lang, None) for lang, _ in groups}:
        n = sum(count[lang, source, t] for t in kept[lang])
        p[lang, source] = {t: 1 + 10**9 * (count[lang, source, t] + 5) // (n + 5 * len(kept[lang])) for t in kept[lang]}
    out = Counter()
    for lang, source in groups:
        pairs = [(-sum(abs(p[lang, source][t] - p[lang, other][t]) for t in kept[lang]), other.encode(), other) for lg, other in groups if lg == lang and other != source]
        own = [(p[lang, None][t] - p[lang, source][t], t.encode(), t) for t in kept[lang] if count[lang, source, t] and p[lang, source][t] > p[lang, None][t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(own)[:top])):
            out.update((lang, source, part, item, -f, i) for i, (f, _, item) in enumerate(found, 1))
    return out


@pytest.mark.parametrize("shard, most, room", [(2048, 64 << 20, 4_000_000), (3, 300, 20)])
def test_divergence_equals_brute_force(spark, monkeypatch, shard, most, room):
    monkeypatch.setattr(divergence, "SHARD_TERMS", shard)
    monkeypatch.setattr(divergence, "PASS_BYTES", most)
    monkeypatch.setattr(divergence, "MOST_SLOTS", room)
    monkeypatch.setattr(divergence, "MOST_ENTRIES", room)
    rng = random.Random(8)
    words = [rng.choice("ab cd éf Ö 日本 zz".split()) + rng.choice(["", "X", "y", "ß", "1q", "-r"]) for _ in range(60)]
    rows = []
    for i in range(240):
        lang, source = rng.choice(["en", "en", "en", "fr", None, ""]), rng.choice(["a", "b", "B", "é", None])
        rows.append((lang, source, " ".join(rng.choices(words[: 20 + 10 * (i % 5)], k=rng.choice([0, 1, 5, 40])))))
    rows += [("en", "a", None), ("de", "x", "alone"), ("de", "y", None), ("xx", "z", "123 45"), ("en", "long", "word " * 50000)] + [("en", "a", "same text here")] * 100
    df = spark.createDataFrame([(*r, i, 1, 2) for i, r in enumerate(rows)], "lang string, source string, text string, doc_id long, shard long, value long").repartition(5)
    got = Counter(tuple(r) for r in divergence.divergence(df, min_docs=6, top=7).collect())
    assert got == brute_divergence(rows, 6, 7)
    assert divergence.divergence(df.limit(0)).count() == 0


def test_perfect_hash_takes_every_slot_once():
    for n in (0, 1, 2, 3, 17, 3000):
        keys = [f"key {i}".encode() for i in range(n)]
        known = perfect_hash.unpacked(perfect_hash.build(keys).packed())
        assert sorted(known.slot(k) for k in keys) == list(range(n))
        assert all(known.key(known.slot(k)) == k for k in keys)
        assert {known.slot(f"other {i}".encode()) for i in range(500)} == {-1}


def test_terms_are_dealt_as_spark_deals_them(spark):
    terms = [b"a", "日本".encode(), b"", b"x" * 100, *[f"t{i}".encode() for i in range(50)]]
    df = spark.createDataFrame([(t,) for t in terms], "term binary").select("term", F.pmod(F.xxhash64("term"), F.lit(7)).alias("s"))
    assert all(divergence.dealt(bytes(r.term), 7) == r.s for r in df.collect()) and xxhash.xxh64_intdigest(b"a", 42)


def test_shares_are_exact():
    import numpy as np

    for total in (0, 7, 10**9, 8 * 10**17):
        counts = np.array([0, 1, total // 3, total], dtype=np.int64)
        assert divergence.share(counts, total, 4).tolist() == [1 + 10**9 * (int(c) + 5) // (total + 20) for c in counts]


# exact deduplication

def test_exact_dedup_equals_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    texts = ["", None, " ", "\t\n", "a b", "a  b", "a\nb", " a b", "a b ", "A b", "x " * 30000, "x  " * 30000, "é b", "é b"]
    rows = [(i, rng.choice(texts) if i % 3 else f"own {i}") for i in range(300)]
    rows += [(7, "a b"), (7, "a b"), (None, "a b"), (None, "only without id"), (None, "only without id"), (-5, "A b"), (400, "hot"), *[(500 + i, "hot") for i in range(200)]]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, cell long, sha long, n long").repartition(11)
    norm = lambda t: re.sub(f"[{SPACE}]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    want = Counter()
    for t, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        want.update((i, least, len(ids), sha, len(t.encode())) for i in ids)
    got = exact_dedup.classes(df).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256, r.n_bytes) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in kept}) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    left = exact_dedup.drop_copies(df)
    assert left.columns == df.columns and Counter((r.doc_id, norm(r.text)) for r in left.collect()) == Counter(
        (min((i for i in ids if i is not None), default=None), t) for t, ids in groups.items())
    assert exact_dedup.classes(df.limit(0)).count() == 0 and exact_dedup.drop_copies(df.limit(0)).count() == 0


def test_rounds_merge_many_runs(spark):
    df = spark.range(4000).selectExpr("3999 - id AS doc_id", "concat('t', CAST(id % 700 AS STRING)) AS text").repartition(70)
    got = exact_dedup.classes(df).groupBy("text_sha256").agg(F.min("keep_id").alias("a"), F.max("keep_id").alias("b"), F.min("doc_id").alias("c"),
                                                             F.max("group_size").alias("s"), F.count(F.lit(1)).alias("n"), F.sum(F.col("kept").cast("int")).alias("k")).collect()
    assert len(got) == 700 and all(r.a == r.b == r.c and r.s == r.n and r.k == 1 for r in got)


def test_merge_carries_over_batches():
    import pyarrow as pa

    def batch(shas):
        k = len(shas)
        return pa.RecordBatch.from_arrays([pa.array([1] * k, pa.int32()), pa.array(shas, pa.binary()), pa.array([3] * k, pa.int64()), pa.array([False] * k),
                                           pa.array(range(k), pa.int64()), pa.array(range(k), pa.int64()), pa.array([2] * k, pa.int64())],
                                          ["cell", "sha", "n_bytes", "no_id", "doc_id", "row", "n"])

    out = [r for b in exact_dedup.merge(iter([batch([b"a", b"a"]), batch([]), batch([b"a"]), batch([b"a", b"b", b"c"]), batch([b"c"])])) for r in b.to_pylist()]
    assert [(r["sha"], r["n"]) for r in out] == [(b"a", 8), (b"b", 2), (b"c", 4)]
