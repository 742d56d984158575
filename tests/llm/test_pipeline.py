"""The pipeline's stages against brute force on a small fixture."""

import pathlib
import random

import corpus_pipeline
from partflow.llm import near_dup
from partflow.llm.common import shared_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, folder):
    rng = random.Random(2)
    vocab = {"en": "the and of to in that with for water house over river light paper green stone".split(), "de": "der und die das mit nicht auf ein wasser haus fluss licht papier stein über grün".split()}
    say = lambda lang, n: " ".join(rng.choice(vocab[lang]) + rng.choice(["", "s", "er", "ing" if lang == "en" else "ung"]) for _ in range(n))
    item = say("en", 14)
    texts = [(say(x, 90), x) for x in ("en", "de") * 20]
    shared = say("en", 30)
    texts[5] = (texts[5][0] + "\n" + shared, texts[5][1])
    texts[8] = (shared + "\n" + texts[8][0], texts[8][1])
    near = texts[3][0].split()
    near[10] = "changed"
    texts += [(" ".join(near), "de"), (texts[4][0] + " " + item.upper() + " end", "en"), (None, None), ("12 34 !!", None), (texts[6][0], "en")]
    rows = [(i, t, lang, f"s{i % 3}", len(t or "")) for i, (t, lang) in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, item


def test_stages(spark, tmp_path):
    rows, item = write(spark, str(tmp_path))
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "mix_sources":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
    clean = {r[0] for r in rows if r[1] and any(c.isalpha() for c in r[1])}
    assert set(seen["language_id"]) == clean
    assert set(seen["line_dedup"]) == clean - {44}  # a copy of 6 has no line left
    assert "\n" not in seen["line_dedup"][8].text and seen["line_dedup"][8].n_chars == len(seen["line_dedup"][8].text)
    kept = sorted(seen["line_dedup"].values(), key=lambda r: r.doc_id)
    sets = [near_dup.shingle_set(r.text, near_dup.SHINGLE) for r in kept]
    gone = {kept[j].doc_id for j in range(len(kept)) for i in range(j) if near_dup.alike(sets[i], sets[j], 80)}
    assert 40 in gone and set(seen["near_dedup"]) == set(seen["line_dedup"]) - gone
    hit = {r.doc_id for r in seen["near_dedup"].values() if item in r.text.lower()}
    assert set(seen["decontaminate"]) == set(seen["near_dedup"]) - hit and (41 in hit or 41 in gone)
    mixed = seen["mix_sources"].values()
    assert all(r.taken == r.size * (r.taken // r.size) and r.taken // r.size in (1, 2, 3) for r in mixed)
    # Mixing by definition: shares by weight, none above three times its size, the excess shared again.
    given = list(seen["decontaminate"].values())
    words = lambda r: len(r.text.split())
    size = {s: sum(words(r) for r in given if r.source == s) for s in ("s0", "s1", "s2")}
    target, open_ = {}, dict(zip(size, (1, 2, 3)))
    while open_:
        left, weight = sum(size.values()) - sum(target.values()), sum(open_.values())
        over = [s for s, w in open_.items() if left * w / weight > 3 * size[s]]
        target |= {s: 3 * size[s] for s in over} if over else {s: left * w / weight for s, w in open_.items()}
        open_ = {s: w for s, w in open_.items() if s not in target}
    copies = [(r.doc_id, r.source, r.shard) for r in docs.collect()]
    for s in size:
        took = sum(words(seen["decontaminate"][d]) for d, source, _ in copies if source == s)
        assert target[s] - max(words(r) for r in given if r.source == s) <= took <= target[s] + 1e-6
    assert all(sum(d == r.doc_id for d, _, _ in copies) <= 3 for r in given) and {d for d, _, _ in copies} <= set(seen["decontaminate"])
    assert {(r.doc_id, r.text) for r in seen["mix_sources"].values()} <= {(r.doc_id, r.text) for r in given}

    shared = pathlib.Path(shared_dir(spark).removeprefix("file://"))
    before = set(shared.iterdir()) if shared.exists() else set()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()
    left = [p.name.split("-")[1] for p in set(shared.iterdir()) - before]
    assert set(left) <= {"decontaminate", "ranges", "blocks", "chosen"}, left  # of all stages the last one's tables and its input


def test_stages_on_empty_and_repeated_rows_and_clashing_columns(spark, tmp_path):
    rows, _ = write(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    odd = docs.union(docs.limit(5)).union(spark.createDataFrame([(None, None, None, None, None), (None, rows[7][1], "de", None, None)], docs.schema))
    odd = odd.selectExpr("*", "1 AS kept", "2 AS score", "3 AS n_lines", "4 AS node", "5 AS items", "6 AS spans")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, str(tmp_path))
        assert out.columns == odd.columns and out.filter("kept <> 1 OR score <> 2 OR n_lines <> 3 OR node <> 4 OR items <> 5 OR spans <> 6").isEmpty()
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), str(tmp_path)).count() == 0
