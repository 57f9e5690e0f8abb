"""The pipeline's stages, each on its own input, against plain versions."""

from collections import Counter, defaultdict

import corpus_pipeline as P
from cofreq.llm import packing, secrets, simhash, toxicity

SF = "/root/testdata/sf0.01"


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def test_stages_one_after_the_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    inputs, outputs = {}, {}
    for name, stage in P.STAGES:
        inputs[name] = docs
        out = stage(spark, docs, SF)
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = outputs[name] = spark.read.parquet(path)
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
            assert [f.dataType for f in docs.schema] == [f.dataType for f in inputs[name].schema]

    # toxicity: exactly the rows that score below the threshold, unchanged
    model = toxicity.train(inputs["toxicity"], labels)
    want = Counter(tuple(r) for r in inputs["toxicity"].collect() if model.score(r.text) < toxicity.THRESHOLD)
    # scores are summed from 32-bit weights on the executors
    assert sum((rows_of(outputs["toxicity"]) - want).values()) + sum((want - rows_of(outputs["toxicity"])).values()) <= 1

    # near duplicates: the smallest doc_id of each group by brute force
    before = inputs["simhash_near_dedup"].collect()
    fps = [simhash.fingerprint(r.text) for r in before]
    low = list(range(len(before)))
    for i in range(len(before)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3 and low[i] != low[j]:
                a, b = low[i], low[j]
                low = [a if x == b else x for x in low]
    best = {}
    for r, g in zip(before, low):
        if g not in best or r.doc_id < best[g].doc_id:
            best[g] = r
    assert rows_of(outputs["simhash_near_dedup"]) == Counter(map(tuple, best.values()))

    # secrets: every document stays, texts without a span as they were
    spans = {r.doc_id: r.spans for r in secrets.find_secrets(inputs["secret_scan"]).collect()}
    after = {r.doc_id: r for r in outputs["secret_scan"].collect()}
    assert len(after) == inputs["secret_scan"].count()
    hit = 0
    for r in inputs["secret_scan"].collect():
        text, at, out = r.text or "", 0, []
        for s in filter(None, spans[r.doc_id].split(",")):
            _, a, b = s.split(":")
            if int(a) >= at:
                out += [text[at:int(a)], "[SECRET]"]
            at = max(at, int(b))
        plain = "".join([*out, text[at:]])
        assert after[r.doc_id].text == plain
        hit += bool(out)
    assert hit

    # mixing: whole documents, up to three times, sources near their targets
    had = rows_of(inputs["source_mixing"])
    took = rows_of(outputs["source_mixing"])
    assert set(took) <= set(had) and all(took[r] <= 3 * had[r] for r in took)
    at = columns.index("text"), columns.index("source")
    size = lambda r: len((r[at[0]] or "").encode().split())
    total, mixed = defaultdict(int), defaultdict(int)
    for r, n in had.items():
        total[r[at[1]]] += n * size(r)
    for r, n in took.items():
        mixed[r[at[1]]] += n * size(r)
    target = targets({s: n for s, n in total.items()})
    largest = max(size(r) for r in had)
    assert all(abs(mixed[s] - target[s]) <= largest for s in total)

    # packing: every id of every copy lies in one piece of a gapless sequence
    from tests.llm.test_packing import check
    check([(r.doc_id, r.text) for r in inputs["packing"].collect()], outputs["packing"].collect())
    assert outputs["packing"].agg({"length": "max"}).first()[0] <= packing.SEQUENCE


def targets(sizes):
    """Weights 1, 2, 3 by code point, capped at three times the size, the
    excess shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped = {}
    while True:
        left = sum(sizes.values()) - sum(capped.values())
        free = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s: 3 * sizes[s] for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {**capped, **share}
        capped.update(over)


def test_run_on_an_empty_table(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").where("false").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_stages_on_awkward_rows(spark):
    """Nulls in any column, empty and long texts, repeated rows, other columns
    with names that the operators use themselves."""
    long = "word " * 60_000
    rows = [(1, "some plain words of text", "en", "a", 24, 0.5), (1, "some plain words of text", "en", "a", 24, 0.5),
            (2, None, None, None, None, None), (None, "no id at all here", "en", None, 17, None),
            (None, None, None, None, None, None), (3, "", "de", "b", 0, 1.0), (4, long, "en", "b", len(long), 1.0),
            (5, "token = \"0123456789abcdef0123456789abcdef\" é", "fr", "c", 45, 2.0)]
    names = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double"
    docs = spark.createDataFrame(rows, names)
    for extra in ("fingerprint", "rid", "size", "copies", "spans", "range", "rank", "group", "place", "h", "bucket", "root",
                  "toxicity", "__toxicity", "__hot", "__runs", "__spans", "__base", "__assign", "__row", "__hit", "__new",
                  "__k0", "__k1", "__k2", "__copies", "__rows", "__copy", "__times", "__n", "__fp", "n", "value", "label"):
        docs = docs.withColumn(extra, docs.score)
    columns, n = docs.columns, {}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns and out.dtypes == docs.dtypes, name
        # every column still holds its own row's values
        assert out.where(" or ".join(f"not (`{c}` <=> score)" for c in columns[6:])).count() == 0, name
        n[name] = out.count()
        assert stage(spark, docs.where("false"), SF).count() == 0, name
    # all share a score column of their own, but no text is toxic
    assert n["toxicity"] == len(rows) and n["secret_scan"] == len(rows)
    # the two equal rows are one group, and so are the texts without words
    assert n["simhash_near_dedup"] == 5
    pieces = P.STAGES[-1][1](spark, docs, SF).collect()
    from tests.llm.test_packing import _ids
    assert sum(p.length for p in pieces) == sum(map(len, _ids([r[1] for r in rows])))
