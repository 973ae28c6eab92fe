"""The pipeline against a brute-force version of each stage on the smallest tables."""

import math
from collections import defaultdict

from tokenizers import Tokenizer

import corpus_pipeline as P
from skeinwork.llm import secrets, toxicity
from skeinwork.llm.queries import QUERIES, tokenizer_file

from .test_llm import base_of, best_fit, deduped, roots, shingle_sets

FOLDER = "/root/testdata/sf0.001"


def is_toxic(text, model):
    """Whether P(grade > 0) is over one half: the sum of weights against the lowest threshold."""
    total = math.fsum(model.weights.get(f, 0.0) for f in toxicity.text_features(text or ""))
    return 1 / (1 + math.exp(min(model.thresholds) - total)) > 0.5


def masked(text, spans):
    """The text with runs of overlapping spans replaced, code point by code point."""
    out, at = "", 0
    for start, end in sorted(spans):
        if start >= at:
            out += text[at:start] + "[secret]"
        at = max(at, end)
    return out + text[at:]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, out = docs.columns, {}
    for n, (name, stage) in enumerate(P.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        source = docs
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        out[name] = docs
        if name == "best-fit packing":
            break
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "toxicity":
            table = spark.read.parquet(f"{FOLDER}/labels.parquet")
            labels = {r.doc_id: r.toxic for r in table.collect()}
            wrong = sum((i in after) == bool(t) for i, t in labels.items() if i in before)
            assert wrong <= 0.15 * len(labels) and all(before[i] == t for i, t in after.items())
            model = toxicity.train(source, table)
            assert set(after) == {i for i, t in before.items() if not is_toxic(t, model)}
        elif name == "line dedup":
            assert after == deduped(before.items())
        elif name == "n-gram Jaccard join":
            sets = shingle_sets(before.items(), 5)
            ids = sorted(sets)
            links = [(a, b) for a in range(len(ids)) for b in range(a) if sets[ids[a]] and 100 * len(sets[ids[a]] & sets[ids[b]]) >= 80 * len(sets[ids[a]] | sets[ids[b]])]
            assert set(after) == {ids[i] for i in set(roots(len(ids), links))}
        elif name == "secret scans":
            spans = {r.doc_id: [(int(x.split(":")[1]), int(x.split(":")[2])) for x in r.spans.split(",") if x] for r in secrets.scan(source).collect()}
            for i, text in before.items():
                assert {(a, b) for a, _, b in base_of(text or "")} <= set(spans[i])
                assert (after[i] or "") == masked(text or "", spans[i])
            assert any(spans.values())
    last = docs.collect()
    tokenizer, pieces = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json")), {}
    for i, text in after.items():
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
        pieces |= {(i, k): min(2048, n - 2048 * k) for k in range(-(-n // 2048))}
    assert {(r.doc_id, r.piece): r.length for r in last} == pieces
    bins = defaultdict(list)
    for r in last:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        places.sort()
        assert [a for a, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 2048
    assert len(bins) == best_fit(pieces.values(), 2048)
    assert [tuple(r)[:5] for r in sorted(P.run(spark, FOLDER).collect())] == [tuple(r)[:5] for r in sorted(last)]


def test_queries_are_named():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 11))
