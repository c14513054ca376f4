import zlib

import numpy as np

from sharedsignal.llm import costpack

import corpus_pipeline as P


def write(spark, folder, docs, labels, bench):
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages_take_effect(spark, rng, tmp_path):
    syllables = ["ba", "ne", "ti", "ro", "sul", "mar", "ken"]
    text = lambda n: " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n)) + "."
    passage, item = text(90), text(14)
    docs, labels = [], []
    for k in range(150):
        t = text(60)
        if k in (10, 20):
            t += " " + passage + " " + text(60)
        if k == 30:
            t += " " + item + " " + text(20)
        docs.append((k, t, "en", f"s{k % 3}", len(t)))
        labels.append((k, 1, 0))
    docs.append((200, docs[5][1], "en", "s0", docs[5][4]))  # a copy
    for k in range(300, 320):
        t = text(60).upper().replace(" ", "$$$ ")
        docs.append((k, t, "en", "s1", len(t)))
        labels.append((k, 0, 0))
    docs += [(400, None, "en", "s", 0), (401, "", None, None, 0)]
    write(spark, tmp_path, docs, labels, [(1, item)])
    stage, table = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, fn in P.STAGES:
        out = fn(spark, table, str(tmp_path))
        if name != "packing":
            assert out.columns == table.columns
        out.write.parquet(f"{tmp_path}/{name}")
        table = spark.read.parquet(f"{tmp_path}/{name}")
        stage[name] = table.collect()
    kept = {r.doc_id for r in stage["quality classifier"]}
    assert not kept & set(range(300, 320)) and not kept & {400, 401} and len(kept & set(range(150))) >= 147
    assert {r.doc_id for r in stage["SimHash near-dedup"]} == kept - {200}
    clean = {r.doc_id: r for r in stage["suffix-array dedup"]}
    for k in (10, 20):
        assert passage[50:-50] not in clean[k].text and clean[k].n_chars == len(clean[k].text)
    assert all(clean[k].text == docs[k][1] for k in clean if k not in (10, 20))
    out = {r.doc_id: r for r in stage["benchmark decontamination"]}
    assert item[:-1] not in out[30].text and all(out[k].text == clean[k].text for k in out if k != 30)
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(costpack.tokenizer_path())
    for r in stage["packing"]:
        ids = np.array(t.encode(out[r.doc_id].text, add_special_tokens=False).ids + [2], np.uint32)
        assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids)
    packed = P.run(spark, str(tmp_path))
    assert packed.columns == table.columns and packed.count() == len(stage["packing"])
    assert [n for n, _ in P.STAGES] == ["quality classifier", "SimHash near-dedup", "suffix-array dedup", "benchmark decontamination", "packing"]


def test_empty_tables(spark, tmp_path):
    write(spark, tmp_path, [], [], [])
    assert P.run(spark, str(tmp_path)).count() == 0
