import io
import zipfile

from folioscope.sources import formats as f


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in members.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), text)
    return out.getvalue()


def test_plain_and_markdown():
    assert f.parse(b"a\nb\fc\n", "x.txt")[1] == [["a", "b"], ["c"]]
    assert f.parse("# T\n\n- *x* [l](u)\n```\ncode\n```\n".encode(), "x.md")[1][0][:3] == ["T", "", "x l"]


def test_tables():
    assert f.parse(b"page,text\n1,a\n2,b\n2,c\n", "x.csv")[1] == [["a"], ["b", "c"]]
    tsv = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n1\t1\t0\t0\t0\t0\t0\t0\t0\t0\t-1\t\n5\t1\t1\t1\t1\t1\t0\t0\t0\t0\t90\tHello\n5\t1\t1\t1\t1\t2\t0\t0\t0\t0\t90\tyou\n1\t2\t0\t0\t0\t0\t0\t0\t0\t0\t-1\t\n"
    assert f.parse(tsv.encode(), "x.tsv")[:2] == ("tesseract", [["Hello you"], []])


def test_json_and_xml():
    assert f.parse(b'{"pages": [{"lines": [{"text": "a b"}]}, {"text": "c"}]}')[1] == [["a b"], ["c"]]
    assert f.parse(b'{"text": "a"}\n{"text": "b"}\n{bad\n', "x.jsonl")[1] == [["a"], ["b"], []]
    assert [(p, i, t, e is None) for _, _, p, i, t, e in f._rows("x.jsonl", b'{"text": "a"}\n{bad\n{"text": "c"}', None)] == [(2, None, None, False), (1, 1, "a", True), (3, 1, "c", True)]
    alto = b'<?xml version="1.0"?><alto xmlns="http://x"><Layout><Page><PrintSpace><TextBlock ID="b2"><TextLine><String CONTENT="two"/></TextLine></TextBlock><TextBlock ID="b1" IDNEXT="b2"><TextLine><String CONTENT="one"/><String CONTENT="x"/></TextLine></TextBlock></PrintSpace></Page></Layout></alto>'
    assert f.parse(alto)[1] == [["one x", "two"]]
    assert f.parse(b'<?xml version="1.0"?><!DOCTYPE a [<!ENTITY b "c">]><a>&b;</a>')[2].startswith("ValueError")
    late = '<?xml version="1.0" encoding="utf-16"?><!-- ' + "x" * 70_000 + ' --><!DOCTYPE a [<!ENTITY b "c">]><a>d</a>'
    assert f.parse(late.encode("utf-16"), "x.xml", "xml")[2].startswith("ValueError")
    tei = b"<TEI><text><body><p>a<lb/>b <choice><sic>x</sic><corr>y</corr></choice></p><pb/><p>c</p></body></text></TEI>"
    assert f.parse(tei)[1] == [["a", "b y"], ["c"]]


def test_html_rtf_subtitles_mail():
    assert f.parse(b"<html><head><title>t</title></head><body><p>a<b>b</b></p><script>x</script>c<br>d</body></html>")[1] == [["ab", "c", "d"]]
    assert f.parse(rb"{\rtf1\ansi{\fonttbl{\f0 A;}}a\par b\u269?c\page d}")[1] == [["a", "bčc"], ["d"]]
    assert f.parse(b"1\n00:00:01,000 --> 00:00:02,000\n<i>Hi</i>\n\n2\n00:00:03,000 --> 00:00:04,000\nyou\n", "x.srt")[1] == [["Hi", "you"]]
    assert f.parse(b"From: a@b\nTo: c@d\nSubject: s\n\nbody\n", "x.eml")[1] == [["From: a@b", "To: c@d", "Subject: s", "body"]]


def test_containers():
    w = 'xmlns:w="http://w"'
    assert f.parse(zipped(word__document_dot_xml=f"<w:document {w}><w:body><w:p><w:r><w:t>a</w:t></w:r></w:p></w:body></w:document>"))[:2] == ("docx", [["a"]])
    assert f.parse(zipped(p10_dot_txt="ten", p2_dot_txt="two", x_dot_md="# m"))[1] == [["two"], ["ten"]]
    assert f.parse(b"%PDF-1.4")[2] and f.parse(b"PK\x03\x04broken")[2]


def test_files_become_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny")
    (tmp_path / "b.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / ".hidden").write_text("no")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.txt").write_text("z")
    rows = f.read_files(spark, str(tmp_path)).orderBy("file", "line_num").collect()
    assert [(r.file, r.text, r.error is None) for r in rows] == [("a.txt", "x", True), ("a.txt", "y", True), ("b.pdf", None, False), ("sub/a.txt", "z", True)]


def test_inflation_is_bounded(monkeypatch):
    import gzip

    monkeypatch.setattr(f, "MAX_BYTES", 1000)
    assert "too large when unpacked" in f.parse(gzip.compress(b"a" * 5000), "x.txt.gz")[2] and f.parse(gzip.compress(b"a" * 500), "x.txt.gz")[2] is None
