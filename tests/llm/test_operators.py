"""The training-data operators against brute force on small tables with every awkward case:
nulls, empty and long texts, ties, repeated rows, empty tables, clashing column names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from pricelens.llm import ann, jaccard_join, line_dedup, mixing, nbsvm, packing, quality_rules, repeats, toxicity, url_filter
from pricelens.llm.queries import public_tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# names that the operators use themselves
CLASHES = ["k1", "k2", "h", "g", "n", "size", "rank", "target", "copies", "score", "predicted", "keep", "cls", "root", "token", "host"]


def words(rng, n):
    return [rng.choice("alpha beta gamma delta the and of stone river light dust café über".split()) + rng.choice(["", "s", "ing", "er", "ly"]) for _ in range(n)]


def corpus():
    rng = random.Random(3)
    passage = " ".join(words(rng, 90))
    line = "A line that many documents share, word by word"
    rows = []
    for i in range(60):
        text = " ".join(words(rng, rng.choice([3, 12, 60, 200])))
        if i % 4 == 0:
            text = f"{text} {passage} {' '.join(words(rng, 20))}"
        if i % 3 == 0:
            text = f"{text}\n {line.upper() if i % 2 else line} \nend {i}"
        rows.append([i, text, f"src{i % 5}"])
    for i in range(60, 75):  # near copies
        w = WORD.findall(rows[7 + i % 3][1]) * 3
        w[i % len(w)] = "edited"
        rows.append([i, " ".join(w), "src0"])
    rows += [[80, None, None], [81, "", "src1"], [82, " \t\n ", None], [83, "one", "src2"], [84, "one two three", "src2"], [85, "ONE two THREE", "src3"]]
    rows += [[90, "ab " * 20000, "src0"], [91, "ab " * 20000, "src0"], [92, "\n".join(["x" * 30] * 50), "src4"]]
    rows += [rows[0][:], rows[0][:], [None, rows[4][1], "src1"], [86, "emoji 😀 line 日本語 <|endoftext|> tail", "src2"]]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    data = [(*r, "en", len(r[1] or ""), *range(len(CLASHES))) for r in corpus()]
    return spark.createDataFrame(data, "doc_id long, text string, source string, lang string, n_chars long, " + ", ".join(f"`{c}` long" for c in CLASHES))


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def rows_of(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("most", [48, 2])
def test_repeats_equal_brute_force(docs, monkeypatch, most):
    monkeypatch.setattr(repeats, "MOST_SEGMENTS", most)
    texts = [(r[0], (r[1] or "").encode()) for r in corpus()]
    times = Counter(t[i: i + 400] for _, t in texts for i in range(len(t) - 399))
    want = Counter()
    for i, t in texts:
        cut = np.zeros(len(t), bool)
        for j in range(len(t) - 399):
            if times[t[j: j + 400]] > 1:
                cut[j: j + 400] = True
        runs = int((np.diff(np.concatenate([[0], cut.astype(int)])) == 1).sum())
        want[(i, len(t), int(cut.sum()), runs, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~cut])).hexdigest())] += 1
    assert rows_of(repeats.remove_repeats(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_maximal_repeats_name_all_occurrences():
    lefts, rights = [b"xab", b"yab", b"ab", b"q"], [b"cdef", b"cdeg", b"cdef", b"zz"]
    groups = {(a, b, tuple(sorted(m))) for a, b, m in repeats.maximal_repeats(lefts, rights, 4)}
    assert (2, 3, (0, 1, 2)) in groups and (2, 4, (0, 2)) in groups


def brute_components(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text, _ in rows:
        w = WORD.findall((text or "").translate(low))
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i: i + 5]) for i in range(len(w) - 4)})
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = defaultdict(list)
    for g, r in zip(group, rows):
        least[g].append(r[0])
    ids = [min((x for x in least[g] if x is not None), default=None) for g in group]
    return group, Counter((r[0], len(s), i) for r, s, i in zip(rows, sets, ids))


@pytest.mark.parametrize("light, paired, block", [(10_000, 32, 256), (0, 0, 4)])
def test_jaccard_join_equals_brute_force(docs, monkeypatch, light, paired, block):
    monkeypatch.setattr(jaccard_join, "LIGHT", light)
    monkeypatch.setattr(jaccard_join, "PAIRED", paired)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    assert rows_of(jaccard_join.jaccard_join(docs), "doc_id", "n_shingles", "component_id") == brute_components(corpus())[1]


def test_jaccard_join_on_a_band_of_near_copies(spark):
    """Members around a common text, some just under the threshold to most others."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        w = base[:]
        for _ in range(rng.choice([1, 2, 3, 4])):
            w[rng.randrange(len(w))] = f"e{rng.random()}"
        rows.append((i, " ".join(w), "s"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert rows_of(jaccard_join.jaccard_join(df), "doc_id", "n_shingles", "component_id") == brute_components(rows)[1]


def test_one_of_each_group_stays(docs):
    rows = corpus()
    group, _ = brute_components(rows)
    wordless = sum(not WORD.findall(r[1] or "") for r in rows)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({g for g, r in zip(group, rows) if WORD.findall(r[1] or "")}) + wordless


def test_line_dedup_equals_brute_force(docs):
    rows = corpus()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(low)
    holders = defaultdict(set)
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(-1 if i is None else i)
    want, texts = Counter(), Counter()
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)]) == (-1 if i is None else i)]
        want[(i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest())] += 1
        texts[(i, t if t is None else "\n".join(keep))] += 1
    assert rows_of(line_dedup.line_dedup(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256") == want
    assert rows_of(line_dedup.drop_lines(docs), "doc_id", "text") == texts


def test_mixing_meets_targets(docs):
    out = mixing.mix(docs).collect()
    sizes = [len(WORD.findall(r[1] or "")) for r in corpus()]
    assert len(out) == len(sizes) and sorted(r["size"] for r in out) == sorted(sizes)
    goal = {(r.source_size, r.target) for r in out}
    assert abs(sum(t for _, t in goal) - 1.5 * sum(sizes)) < 1e-6
    taken, most = defaultdict(int), max(sizes)
    for r in out:
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[(r.source_size, r.target)] += r.taken
    assert sum(taken.values()) <= 1.5 * sum(sizes) + 1e-6
    assert all(abs(taken[g] - g[1]) <= most for g in goal) and all(t <= 2 * s + 1e-9 for s, t in goal)
    again = mixing.mix(docs)
    assert rows_of(again, "doc_id", "size", "taken") == Counter((r.doc_id, r["size"], r.taken) for r in out)
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mixed(docs).count() == sum(r.copies for r in out)


def reshared(sizes, budget):
    """Targets by source as the words of the contract put them: share, cut, reshare."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    goal = dict.fromkeys(names, 0.0)
    left, open_ = budget, set(names)
    while left > 1e-9 and open_:
        share = left / sum(weight[s] for s in open_)
        for s in open_:
            goal[s] += weight[s] * share
        left = sum(max(0.0, goal[s] - 2 * sizes[s]) for s in open_)
        for s in names:
            goal[s] = min(goal[s], 2.0 * sizes[s])
        open_ = {s for s in open_ if goal[s] < 2 * sizes[s]}
    return goal


@pytest.mark.parametrize("many", [1, 30])
def test_mixing_of_many_like_sources_equals_resharing(spark, many, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 50)
    rng = random.Random(many)
    rows = [(i, "w " * rng.randint(0, 30), f"s{i % 20}" if i % 21 else None) for i in range(40 * many)]
    rows += [(5000 + i, " ", "blank") for i in range(200)]
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    goal = reshared(sizes, 1.5 * sum(sizes.values()))
    taken, most = Counter(), defaultdict(int)
    source_of = {i: s for i, _, s in rows}
    for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        s = source_of[r.doc_id]
        assert abs(r.target - goal[s]) < 1e-6 and r.source_size == sizes[s]
        taken[s] += r.taken
        most[s] = max(most[s], r["size"])
    assert abs(sum(goal.values()) - 1.5 * sum(sizes.values())) < 1e-6
    assert all(abs(taken[s] - goal[s]) <= most[s] + 1e-6 for s in sizes)


def test_mixed_keeps_columns_of_rows_that_differ_elsewhere(spark):
    df = spark.createDataFrame([(1, "a b", "s", "x"), (1, "a b", "s", "y")], "doc_id long, text string, source string, note string")
    assert {r.note for r in mixing.mixed(df).collect()} == {"x", "y"}


@pytest.mark.parametrize("segments, loss", [(256, 2048), (3, 900)])
def test_packing_places_every_id_once(docs, segments, loss):
    from tokenizers import Tokenizer

    files = public_tokenizer()
    tokenizer = Tokenizer.from_file(files["tokenizer"])
    df = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    out = packing.pack(df, **files, segments=segments, loss=loss).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    assert set(pieces) == set(texts)
    for i, t in texts.items():
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at: at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= min(2048, loss) and len(rows) <= segments
        if (segments, loss) == (256, 2048):
            assert at & (at - 1) == 0  # full, or a power of two


def test_quality_rules_equal_brute_force(docs):
    want = Counter()
    for i, t, _ in corpus():
        t = t or ""
        w = WORD.findall(t)
        at = defaultdict(list)
        for j in range(len(w) - 2):
            at[tuple(w[j: j + 3])].append(j)
        again = {j + k for places in at.values() if len(places) > 1 for j in places for k in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        want[(i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), failed)] += 1
    out = quality_rules.quality_rules(docs)
    assert rows_of(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    assert out.where("base_failed AND kept").count() == 0
    assert "Python" not in out._jdf.queryExecution().toString() and "Exchange" not in out._jdf.queryExecution().toString()


def test_url_filter_is_exact(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "SHARD_KEYS", 50)
    hosts = [f"h{i}.example.net" for i in range(700)]
    urls = [(i, f"http://{h.upper() if i % 5 == 0 else h}/x{i}?q#f", i) for i, h in enumerate(hosts)]
    urls += [(900, None, 1), (901, "no scheme", 1), (902, "x://A.org/en", 1), (903, "x://a.example.org/en/12", 1), (904, "x://org?en", 1), (905, "x://org?en", 1), (None, "s://h3.example.net", 2)]
    pages = spark.createDataFrame(urls, "page_id long, url string, host long")
    listed = spark.createDataFrame([(h,) for i, h in enumerate(hosts) if i % 7 == 0] + [("not.there",), (None,)], "host string")
    for limit in (url_filter.PASS_BYTES, 1):
        monkeypatch.setattr(url_filter, "PASS_BYTES", limit)
        got = {(r.page_id, r.host, r.path): (r.rule, r.verdict) for r in url_filter.url_filter(pages, listed, url_filter.RULES).collect()}
        for i, h in enumerate(hosts):
            assert got[(i, h, f"/x{i}")] == (None, "block" if i % 7 == 0 else "allow")
        assert got[(900, "", "")] == got[(901, "", "")] == (None, "allow")
        assert got[(902, "a.org", "/en")] == ("org/", "allow") and got[(903, "a.example.org", "/en/12")] == ("example.org/en/1", "block")
        assert got[(904, "org", "")] == (None, "allow") and got[(None, "h3.example.net", "")] == (None, "allow")
    empty = url_filter.url_filter(pages.limit(0), listed, url_filter.RULES)
    assert empty.count() == 0


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[600:1100] = x[600]  # a third are copies
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(2000, None, 0), (2100, [0.0] * 16, 0), (2200, [float("nan")] + [1.0] * 15, 0), (2300, [None] + [1.0] * 15, 0), (2400, [1.0], 0), (None, x[3].tolist(), 0), (5, x[5].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = defaultdict(list)
    for r in sorted(ann.nearest(df, lambda i: i % 100 == 0).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append(r)
    assert sorted(got) == list(range(0, 1500, 100))
    hits = 0
    y = x.astype(float)
    for q, rs in got.items():
        d = np.sqrt(((y[q] - y) ** 2).sum(1))
        best = [i for i in np.lexsort((np.arange(len(y)), d)) if i != q][:10]
        assert [r["rank"] for r in rs] == list(range(1, 11))
        assert all(r.score == np.sqrt(((y[q] - y[r.vec_id]) ** 2).sum()) for r in rs)
        assert [(r.score, r.vec_id) for r in rs] == sorted((r.score, r.vec_id) for r in rs)
        hits += len(set(best) & {r.vec_id for r in rs})
    assert hits >= 0.9 * 10 * len(got)
    few = ann.nearest(df.where("vec_id IN (0, 1, 2)"), lambda i: i % 100 == 0)
    assert [r.vec_id for r in few.orderBy("rank").collect()] == sorted([1, 2], key=lambda j: ((y[0] - y[j]) ** 2).sum())
    assert ann.nearest(df.limit(0), lambda i: i % 100 == 0).count() == 0


def test_calibration_walks_as_queries_do(monkeypatch):
    rng = np.random.default_rng(8)
    c = rng.normal(size=(3000, 24))
    links = ann.graph_of(c)
    assert ann.BEAM * links.shape[1] < len(c)  # the graph is walked
    q = rng.normal(size=(60, 24))
    d = ann.squared(q, c)
    held = [(i, [int(x)]) for i in range(len(q)) for x in np.argsort(d[i])[:20]]
    beam, margin = ann.calibrated(q, held, c, links)
    ids, dist = ann.walk(q, c, links, beam)
    got = [bool(np.isin(ids[i], x).any()) and dist[i][np.isin(ids[i], x)][0] - dist[i, 0] <= margin for i, x in held]
    assert np.mean(got) >= ann.TARGET
    assert ann.calibrated(q[:0], [], c, links) == (0, 0.0)


@pytest.mark.parametrize("per_list", [50, 10])
def test_nearest_over_several_hundred_lists(spark, tmp_path, monkeypatch, per_list):
    """Some hundred lists, all of which are ranked, and 3,000 lists, for which the graph is walked."""
    monkeypatch.setattr(ann, "PER_LIST", per_list)
    x = np.random.default_rng(4).normal(size=(30_000, 48)).astype(np.float32)
    table = pa.table({"vec_id": pa.array(np.arange(len(x))), "embedding": pa.array(list(x), pa.list_(pa.float32()))})
    pq.write_table(table, tmp_path / "v.parquet")
    got = defaultdict(set)
    for r in ann.nearest(spark.read.parquet(str(tmp_path)), lambda i: i % 100 == 0).collect():
        got[r.query_id].add(r.vec_id)
    y = x.astype(float)
    hits = 0
    for q in range(0, len(y), 100):
        d = ((y[q] - y) ** 2).sum(1)
        d[q] = np.inf
        hits += len(got[q] & set(np.argsort(d)[:10].tolist()))
    assert len(got) == 300 and hits >= 0.9 * 10 * len(got), hits


def test_boundary_vectors_are_replicated():
    rng = np.random.default_rng(6)
    c = rng.normal(size=(40, 64)) * 0.1  # centroids lie close together, vectors far off
    a, b = c[0], c[1 + np.argmin(ann.squared(c[:1], c[1:]))]
    off = rng.normal(size=64)
    off -= (off @ (b - a)) / ((b - a) @ (b - a)) * (b - a)
    d = ann.squared(np.array([(a + b) / 2 + 0.01 * off, a + 0.01 * off]), np.array([a, b]))
    assert ann.lists_of(d + [[0.5], [0.5]], ann.squared(np.array([a, b]), np.array([a, b])))[1].sum(1).tolist() == [2, 1]


def test_reach_keeps_the_target():
    rng = np.random.default_rng(7)
    places, margins = rng.integers(0, 500, 2000), rng.random(2000)
    width, margin = ann.reach(places, margins)
    assert ann.TARGET <= ((places < width) & (margins <= margin)).mean() and width < 500 and ann.reach(places[:0], margins[:0]) == (0, 0.0)


def labelled(spark, bad_text):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        w = words(rng, rng.choice([30, 80, 150]))
        bad = i % 4 == 0
        rows.append((i, bad_text(w, rng) if bad else " ".join(w[: len(w) // 2]) + ". " + " ".join(w[len(w) // 2:]) + "."))
        labels.append((i, int(bad)))
    rows += [(700, None), (701, ""), (702, "the stone " * 30000), (None, "river light")]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (599, None), (9999, 1)], "doc_id long, toxic int").withColumn("quality", 1 - __import__("pyspark").sql.functions.col("toxic"))


def test_toxicity_on_held_out(spark):
    docs, labels = labelled(spark, lambda w, rng: " ".join(w[:10]) + f". You {rng.choice(['vile', 'rotten', 'nasty'])} thing. " + " ".join(w[10:]) + ".")
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == 604 and all(0 <= r.score <= 1 for r in out)
    known = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in known) >= 0.97 * len(known)
    texts = {r.doc_id: r.text.encode() for r in docs.where("text IS NOT NULL").collect()}
    found = [texts[r.doc_id][s.start: s.end] for r in out if r.doc_id is not None and r.doc_id < 600 and r.doc_id % 4 == 0 for s in r.spans]
    assert found and sum(x.startswith(b"You") for x in found) >= 0.9 * len(found)
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0 and toxicity.toxicity(docs, labels.limit(0)).count() == 604


def test_quality_classifier_on_held_out(spark):
    docs, labels = labelled(spark, lambda w, rng: " ".join(x.upper() + "!!" for x in w))
    out = nbsvm.quality(docs, labels).collect()
    assert len(out) == 604 and all(0 <= r.score <= 1 for r in out)
    known = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert sum(r.predicted == int(r.doc_id % 4 != 0) for r in known) >= 0.97 * len(known)
    wide = docs.selectExpr("*", "1 AS score", "2 AS predicted")
    kept = nbsvm.keep_good(wide, labels)
    assert kept.columns == wide.columns and 440 <= kept.count() <= 460
    assert nbsvm.quality(docs.limit(0), labels).count() == 0 and nbsvm.quality(docs, labels.limit(0)).count() == 604


def test_empty_tables(none):
    assert repeats.remove_repeats(none).count() == 0
    assert jaccard_join.jaccard_join(none).count() == 0 and jaccard_join.one_of_each(none).count() == 0
    assert line_dedup.line_dedup(none).count() == 0 and line_dedup.drop_lines(none).count() == 0
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0
    assert packing.pack(none, **public_tokenizer()).count() == 0
    assert quality_rules.quality_rules(none).count() == 0
