import json

from folioscope.plans import batch


def test_batch_job(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("Pohled na starý zámek od jihu\n\n12 34 56\n")
    (source / "b.pdf").write_bytes(b"%PDF-1.4")
    out = batch.run(spark, str(source), str(tmp_path / "out"))
    page = out["pages"].first()
    assert (page.clear, page.empty, page["non-text"]) == (1, 1, 1) and out["errors"].count() == 1
    assert len(json.loads(out["records"].first().record)["lines"]) == 3
