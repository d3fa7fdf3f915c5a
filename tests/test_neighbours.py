"""One-edit neighbours of all rare tokens against brute force."""

from folioscope import queries as q


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_all_rare_tokens(spark, tmp_path):
    strong = ["archive", "stone", "at", "wall", "ceramics", "hřbitov"]
    rare = ["archve", "archivee", "stoen", "stome", "stone", "as", "wal", "wale", "walls", "cerammics", "hrbitov", "hřbitovy", "other"]
    docs = [" ".join(strong + [r for k, r in enumerate(rare) if i == k or (k % 2 and i == k + 1)]) for i in range(25)]
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").selectExpr("*", "'en' as lang", "'s' as source").write.parquet(str(tmp_path / "documents.parquet"))
    df = {w: sum(w in d.split() for d in docs) for w in {*strong, *rare}}
    want = {(a, b, df[b]) for a in df for b in df if df[a] < 3 and df[b] >= 20 and one_edit(a, b)}
    got = [tuple(r) for r in q.queries()["one_edit_neighbours"](spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) and set(got) == want and {len(a) for a, _, _ in want} > {2, 6} and {df[a] for a, _, _ in want} == {1, 2}
