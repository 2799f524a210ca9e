"""The pipeline against its stages in brute force, and the fitted models against direct solutions."""

import hashlib
import importlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from pricelens.llm import nbsvm, packing, toxicity
from tests.llm.test_operators import WORD, brute_components, corpus, reshared

pipeline = importlib.import_module("corpus_pipeline")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, k1 long, keep long, score double"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("tables")
    rng = random.Random(12)
    rows = [[r[0], r[1], "en", r[2], len(r[1] or ""), 1, 2, 0.5] for r in corpus()]
    rows += [[1000 + i, " ".join(rng.choice("good text reads well and says a lot about rivers stones light".split()) for _ in range(rng.randint(20, 120))) + ".", "en", f"src{i % 7}", 0, 1, 2, 0.5] for i in range(120)]
    rows += [[2000 + i, " ".join(rng.choice("BUY NOW!! CLICK!!! $$$ FREE###".split()) for _ in range(60)), None, None, None, None, None, None] for i in range(60)]
    labels = [(r[0], int(r[0] < 2000), 0) for r in rows if r[0] is not None] + [(None, 1, 0), (5, None, None), (99999, 0, 1)]
    spark.createDataFrame(rows, COLUMNS).repartition(4).write.parquet(str(home / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(home / "labels.parquet"))
    return str(home)


def brute_lines(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(low)
    number = lambda i: -(2**63) if i is None else i
    holders = defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(number(i))
    out = []
    for i, text, *rest in rows:
        keep = [x for x in (text or "").split("\n") if len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)]) == number(i)]
        out.append((i, None if text is None else "\n".join(keep), *rest))
    return out


def brute_mix(rows):
    """How often the mix takes each row, by one sorted line of finish times."""
    size = lambda r: len(WORD.findall(r[1] or ""))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r)
    budget = 1.5 * sum(sizes.values())
    goal = reshared(sizes, budget)
    rank = {s: i for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    h = lambda r: hashlib.md5(f"{'' if r[0] is None else r[0]}:mix".encode()).hexdigest()
    line, full = [], defaultdict(int)
    for turn in (0, 1):
        done = Counter()
        for r in sorted(rows, key=lambda r: (rank[r[3]], h(r))):
            done[r[3]] += size(r)
            v = (done[r[3]] + turn * sizes[r[3]]) / goal[r[3]] if goal[r[3]] > 0 else 0.0
            line.append((v, rank[r[3]], turn, -1 if r[0] is None else r[0], r))
    total, last = 0, None
    for item in sorted((x for x in line if size(x[4])), key=lambda x: x[:4]):
        total += size(item[4])
        if total > budget:
            break
        last = item[:4]
    taken = Counter()
    for item in line:
        if last is not None and item[:4] <= last:
            taken[item[4]] += 1
    return taken, goal, sizes


def test_pipeline_equals_chained_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    now, before = docs, [tuple(r) for r in docs.collect()]
    assert [n for n, _ in pipeline.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "mixing", "packing"]
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, now, tables)
        assert out.columns == docs.columns
        got = [tuple(r) for r in out.collect()]
        if name == "quality_classifier":
            assert set(got) <= set(before) and Counter(got) <= Counter(before)
            assert not any(r[0] is not None and 2000 <= r[0] < 2100 for r in got)
            assert sum(r[0] is not None and 1000 <= r[0] < 1200 for r in got) == 120
        elif name == "line_dedup":
            assert Counter(got) == Counter(brute_lines(before))
        elif name == "ngram_jaccard_join":
            rows = [r[:3] for r in before]
            group, _ = brute_components(rows)
            wordless = Counter(r for r in before if not WORD.findall(r[1] or ""))
            least = {g: min((before[i] for i in range(len(rows)) if group[i] == g), key=lambda r: (r[0] is None, r[0] or 0))[0] for g in set(group)}
            want = Counter(least[g] for g in {g for g, r in zip(group, before) if WORD.findall(r[1] or "")})
            assert Counter(r[0] for r in got if WORD.findall(r[1] or "")) == want
            assert Counter(r for r in got if not WORD.findall(r[1] or "")) == wordless
        else:
            taken, goal, sizes = brute_mix(before)
            words = Counter()
            for r in got:
                words[r[3]] += len(WORD.findall(r[1] or ""))
            most = max(len(WORD.findall(r[1] or "")) for r in before)
            assert all(abs(words[s] - goal[s]) <= most for s in sizes)
            assert Counter(r for r in got if WORD.findall(r[1] or "")) == Counter({r: n for r, n in taken.items() if WORD.findall(r[1] or "")})
        before = got
        out.write.parquet(f"{tables}/stage-{name}")
        now = spark.read.parquet(f"{tables}/stage-{name}")
    last = pipeline.STAGES[-1][1](spark, now, tables)
    pieces = last.collect()
    lengths = Counter()
    for r in pieces:
        lengths[r.doc_id] += r.length
    whole = Counter()
    for r in {(r.doc_id, r.doc_tokens) for r in pieces}:
        whole[r[0]] += 1
    copies = Counter(r[0] for r in before)
    assert set(lengths) == set(copies)
    for key, n in copies.items():
        if whole[key] == 1:
            assert lengths[key] == n * next(r.doc_tokens for r in pieces if r.doc_id == key)
    # the run is the same chain; where pieces are cut depends on the partitions
    one = Counter(r.doc_id for r in pipeline.run(spark, tables).where("start = 0").collect())
    assert one == Counter(r.doc_id for r in pieces if r.start == 0)


def test_pipeline_on_empty_tables(spark, tables, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_noisy_or_fit_is_a_stationary_point():
    """The penalised likelihood, written out anew, has no slope at the fitted weights."""
    rng = np.random.default_rng(3)
    y = np.array([1, 0] * 30)
    slots, sentence, of = [], [], []
    for doc, label in enumerate(y):
        for _ in range(rng.integers(1, 4)):
            of.append(doc)
            for word in rng.choice(6, size=3):
                slots.append(word + (6 if label and rng.random() < 0.5 else 0))
                sentence.append(len(of) - 1)
    slots, sentence, of = np.array(slots), np.array(sentence), np.array(of)
    shrink = 0.5
    model = toxicity.fit(slots, sentence, of, y, rounds=6000, rate=0.02, shrink=shrink, errors=0.0, least=1)
    names = np.unique(slots)

    def loss(w):
        weights = np.zeros(1 << toxicity.BITS)
        weights[names] = w[:-1]
        clean = np.zeros(len(y))
        for s in range(len(of)):
            z = weights[slots[sentence == s]].sum() + w[-1]
            clean[of[s]] += np.log1p(np.exp(z))
        return np.where(y == 1, -np.log(-np.expm1(-clean)), clean).mean() + shrink / len(y) * 0.5 * (w[:-1] ** 2).sum()

    w = np.append(model.weights[names].astype(float), model.bias)
    slope = [(loss(w + 1e-4 * e) - loss(w - 1e-4 * e)) / 2e-4 for e in np.eye(len(w))]
    away = np.append(np.zeros(len(names)), -4.0)
    start = [(loss(away + 1e-4 * e) - loss(away - 1e-4 * e)) / 2e-4 for e in np.eye(len(w))]
    assert np.abs(slope).max() < 0.02 * np.abs(start).max(), slope


def test_coordinate_descent_reaches_the_direct_dual_solution():
    rng = np.random.default_rng(5)
    y = np.array([0, 1] * 20)
    slots = [np.unique(rng.choice(12, size=5) + (4 if label else 0)) for label in y]
    r = np.zeros(nbsvm.SLOTS)
    r[:16] = rng.normal(size=16)
    w, bias = nbsvm.descend(slots, y, r, cost=1.0, epochs=4000)
    x = np.zeros((len(y), 17))
    for i, s in enumerate(slots):
        x[i, s] = r[s]
    x[:, 16] = 1.0
    sign = np.where(y == 1, 1.0, -1.0)
    gram = (x * sign[:, None]) @ (x * sign[:, None]).T
    alpha = np.zeros(len(y))
    rate = 1.0 / np.linalg.eigvalsh(gram).max()
    for _ in range(200_000):
        alpha = np.clip(alpha + rate * (1.0 - gram @ alpha), 0.0, 1.0)
    direct = (alpha * sign) @ x
    primal = lambda v: 0.5 * v @ v + np.maximum(0.0, 1.0 - sign * (x @ v)).sum()
    dual = alpha.sum() - 0.5 * direct @ direct
    own = np.append(w[:16], bias)
    assert primal(direct) - dual < 1e-3 and primal(own) - dual < 1e-2 * max(1.0, dual)
    assert not w[16:].any()


def test_prompt_ids_bear_no_loss_and_the_loss_limit_binds():
    """Prompt and answer lengths as in instruction data: three limits at once, each of which binds somewhere."""
    rng = np.random.default_rng(9)
    docs = [(int(rng.integers(1, 900)), int(rng.integers(1, 400))) for _ in range(400)] + [(2, 1)] * 600
    packer = packing.Packer(0, capacity=2048, segments=12, loss=700)
    spans = defaultdict(list)
    for key, (prompt, answer) in enumerate(docs):
        packer.add(key, np.arange(prompt + answer, dtype=np.uint32), prompt)
    packer.finish()
    tight = Counter()
    for key, start, length, _, total, sequence, offset in packer.out:
        spans[key].append((start, length))
        tight[sequence, "tokens"] += length
        tight[sequence, "segments"] += 1
        tight[sequence, "loss"] += max(0, start + length - max(start, docs[key][0]))
    for key, (prompt, answer) in enumerate(docs):
        at = 0
        for start, length in sorted(spans[key]):
            assert start == at and length > 0
            at += length
        assert at == prompt + answer
    limits = {"tokens": 2048, "segments": 12, "loss": 700}
    assert all(n <= limits[kind] for (_, kind), n in tight.items())
    assert all(any(n == limits[kind] for (_, k), n in tight.items() if k == kind) for kind in limits)


def test_packing_of_repeated_rows_and_null_ids(spark):
    from pricelens.llm.queries import public_tokenizer

    df = spark.createDataFrame([(1, "a b c", 2), (1, "a b c", 2), (None, "x", 0), (None, None, None)], "doc_id long, text string, quiet long")
    out = packing.pack(df, **public_tokenizer(), quiet="quiet", loss=2048).collect()
    assert Counter(r.doc_id for r in out if r.start == 0) == {1: 2, None: 2} and sum(r.length for r in out if r.doc_id == 1) == 2 * next(r.doc_tokens for r in out if r.doc_id == 1)


def test_models_on_repeated_rows_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "good words here", 3.0, 1, 2), (1, "good words here", 3.0, 1, 2), (2, None, None, None, None)], "doc_id long, text string, score double, predicted int, spans int")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for out in (toxicity.toxicity(docs, labels), nbsvm.quality(docs, labels)):
        got = out.collect()
        assert Counter(r.doc_id for r in got) == {1: 2, 2: 1} and len({r.score for r in got if r.doc_id == 1}) == 1
