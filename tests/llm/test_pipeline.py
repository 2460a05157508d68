import corpus_pipeline as cp
from tables import documents, prose
from test_decontaminate import brute as leaks
from test_near_dups import brute as groups

from tidemart.llm import pieces, pii


def tables(spark, folder):
    bad = [" ".join([*prose(i, 30), "idiot", *prose(i + 500, 10)]) for i in range(6)]
    item = " ".join(prose(77, 30))
    clean = [" ".join(prose(i, 60, 2000)) for i in range(20, 40)]
    texts = [*bad, *clean, clean[0], clean[1] + " more", f"{clean[2][:40]} {item} end", "mail me@host.com now or never", "", None]
    documents(spark, texts).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return texts, item


def test_stages_and_run(spark, tmp_path):
    texts, item = tables(spark, str(tmp_path))
    docs = cp.table(spark, str(tmp_path), "documents")
    columns, stages = docs.columns, dict(cp.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "personal_data", "pieces"]

    def texts_of(df):
        assert df.columns == columns
        return {r.doc_id: r.text for r in df.collect()}

    kept = {i: t for i, t in enumerate(texts) if "idiot" not in (t or "")}
    assert texts_of(stages["toxicity"](spark, docs, str(tmp_path))) == kept
    found = groups(texts)
    kept = {i: t for i, t in enumerate(texts) if found[i][1] == i}
    assert texts_of(stages["near_duplicates"](spark, docs, str(tmp_path))) == kept
    kept = {i: t for i, t in enumerate(texts) if not (t and leaks(t, [(1, item)]))}
    assert len(kept) == len(texts) - 1
    assert texts_of(stages["decontamination"](spark, docs, str(tmp_path))) == kept
    kept = {i: t and pii.redact(t, pii.plain_spans(t)) for i, t in enumerate(texts)}
    assert texts_of(stages["personal_data"](spark, docs, str(tmp_path))) == kept

    left = {i for i, t in enumerate(texts) if "idiot" not in (t or "") and found[i][1] == i and not (t and leaks(t, [(1, item)]))}
    rows = pieces.decoded(cp.run(spark, str(tmp_path)), "ids", "again").collect()
    assert {r.doc_id: r.again for r in rows} == {i: kept[i] for i in left}


def test_empty_tables(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def five_word_groups(texts):
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    up = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                up = [min(up[i], up[j]) if u in (up[i], up[j]) else u for u in up]
    return up


def test_near_duplicates_are_told_by_five_words(spark):
    a, b = prose(1, 100, 2000), prose(2, 150, 2000)
    scattered = [f"new{i}" if i in (20, 50, 80, 110) else w for i, w in enumerate(b)]
    # 96/116 of five words, but 98/118 of three; and 126/166 of five words, but 136/160 of three.
    texts = [" ".join(t) for t in (a, a + prose(3, 20, 2000), b, scattered, ["a", "few", "words"], ["A", "few", "words"])]
    found = groups(texts)
    assert [c for _, c in found] == [0, 1, 2, 2, 4, 4]
    kept = dict(cp.STAGES)["near_duplicates"](spark, documents(spark, texts), "")
    wanted = [i for i, root in enumerate(five_word_groups(texts)) if root == i]
    assert wanted == [0, 2, 3, 4]
    assert sorted(r.doc_id for r in kept.collect()) == wanted
