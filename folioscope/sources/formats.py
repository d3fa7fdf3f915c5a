"""Readers of document files: bytes to pages of lines.

``read_files`` lists files with the binaryFile source and parses each where it lies; a file that cannot be read gives
one row with its error instead of failing the job. Every reader is a function of bytes returning pages, each a list
of lines, found in ``READERS`` by kind; ``sniff`` tells the kind from the content, then the name.
"""

from __future__ import annotations

import bz2
import contextlib
import csv
import email
import email.policy
import gzip
import io
import json
import lzma
import re
import unicodedata
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Pages = list[list[str]]
MAX_BYTES = 256 << 20
FALLBACKS = ("cp1250", "iso8859_2", "cp1252")
SCHEMA = "file string, kind string, page_num int, line_num int, text string, error string"
#: Keys under which OCR services put text.
TEXT_KEYS = ("text", "content", "line", "transcription", "value", "words", "lines")


def decode(data: bytes) -> str:
    """Text of bytes: byte order mark, UTF-8, UTF-16 by its zero bytes, then single-byte code pages."""
    for mark, name in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if data.startswith(mark):
            return data.decode(name, "replace")
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        pass
    head = data[:4096]
    for name, at in (("utf-16-le", head[1::2]), ("utf-16-be", head[::2])):
        if len(at) > 8 and at.count(0) > 0.4 * len(at):
            return data.decode(name, "replace")
    for name in FALLBACKS:
        try:
            return data.decode(name)
        except UnicodeDecodeError:
            continue
    return data.decode("utf-8", "replace")


def clean(line: str) -> str:
    """One line in NFC, ligatures apart, without zero-width and control characters, no-break space as space."""
    line = unicodedata.normalize("NFC", line).translate({0xA0: " ", 0xAD: None, 0x200B: None, 0x200C: None, 0x200D: None, 0xFEFF: None, 0xFB00: "ff", 0xFB01: "fi", 0xFB02: "fl", 0xFB03: "ffi", 0xFB04: "ffl"})
    return "".join(c if c >= " " or c == "\t" else " " for c in line).rstrip()


def plain(data: bytes) -> Pages:
    pages = [p.split("\n") for p in re.sub(r"\r\n?|\x0b|\x85|\u2028|\u2029", "\n", decode(data)).split("\f")]
    pages = [p[:-1] if p and not p[-1] else p for p in pages]
    while pages and not any(x.strip() for x in pages[-1]):
        pages.pop()
    return pages


_INLINE = ((r"!\[([^\]]*)\]\([^)]*\)", r"\1"), (r"\[([^\]]*)\]\([^)]*\)", r"\1"), (r"<(https?://[^>]+)>", r"\1"), (r"(\*\*|__)(.+?)\1", r"\2"), (r"(?<!\w)[*_](.+?)[*_](?!\w)", r"\1"), (r"`+([^`]*)`+", r"\1"), (r"</?[A-Za-z][^>]*>", ""), (r"\\([\\`*_{}\[\]()#+.!-])", r"\1"))


def markdown(data: bytes) -> Pages:
    text = re.sub(r"\A---\n.*?\n---\n", "", decode(data).replace("\r\n", "\n"), flags=re.S)
    out, fence = [], False
    for line in re.sub(r"<!--.*?-->", "", text, flags=re.S).split("\n"):
        if re.match(r"\s*(```|~~~)", line):
            fence = not fence
        elif fence:
            out.append(line)
        elif not re.fullmatch(r"\s*(?:[-*_=]\s*){3,}|\s*\|?[\s:|-]+\|?\s*", line) or not line.strip():
            line = re.sub(r"^\s*(?:#{1,6}\s+|>\s?|[-*+]\s+|\d+[.)]\s+)+", "", line)
            for a, b in _INLINE:
                line = re.sub(a, b, line)
            out.append(" ".join(c.strip() for c in line.strip().strip("|").split("|")) if line.count("|") > 1 else line.rstrip())
    return [out]


def _grouped(rows: list[tuple]) -> Pages:
    """Pages of words keyed (page, line address, word): lines in order, words joined by spaces."""
    pages: dict = {}
    for page, line, word in rows:
        pages.setdefault(page, {}).setdefault(line, []).append(word)
    return [[" ".join(w) for w in p.values()] for p in pages.values()]


def table(data: bytes, delimiter: str | None = None) -> Pages:
    """CSV or TSV: a page column groups, the text column (by name, else the wordiest) gives lines."""
    text = decode(data)
    delimiter = delimiter or max(",;\t|", key=text[:4096].count)
    quoting = csv.QUOTE_MINIMAL if text.count('"') % 2 == 0 else csv.QUOTE_NONE
    rows = [r for r in csv.reader(io.StringIO(text), delimiter=delimiter, quoting=quoting) if r]
    if not rows:
        return []
    head = [c.strip().lower() for c in rows[0]]
    if {"level", "page_num", "block_num", "text"} <= set(head):
        return tesseract(data)
    named = [i for i, c in enumerate(head) if c in ("text", "content", "line", "transcription")]
    body = rows[1:] if named or "page" in head or "page_num" in head else rows
    column = named[0] if named else max(range(len(rows[0])), key=lambda i: sum(len(r[i]) for r in body if len(r) > i))
    page = next((i for i, c in enumerate(head) if c in ("page", "page_num")), None)
    pages: dict = {}
    for r in body:
        if len(r) > column:
            pages.setdefault(r[page] if page is not None and len(r) > page else "", []).extend(r[column].split("\n"))
    return list(pages.values())


def tesseract(data: bytes) -> Pages:
    rows = csv.DictReader(io.StringIO(decode(data)), delimiter="\t", quoting=csv.QUOTE_NONE)
    found, pages = [], {}
    for r in rows:
        if r["level"] == "1":
            pages[r["page_num"]] = []
        elif r["level"] == "5" and (r["text"] or "").strip():
            found.append((r["page_num"], (r["block_num"], r["par_num"], r["line_num"]), r["text"]))
    for number, page in zip(dict.fromkeys(f[0] for f in found), _grouped(found), strict=True):
        pages[number] = page
    return list(pages.values())


def _leaves(x, named: bool = False) -> Iterator[str]:
    if isinstance(x, str):
        if named and not re.fullmatch(r"[A-Za-z0-9+/=]{200,}|[0-9a-f]{64,}", x):
            yield from x.split("\n")
    elif isinstance(x, list):
        if x and all(isinstance(w, dict) and isinstance(w.get("text"), str) and " " not in w["text"] for w in x):
            yield " ".join(w["text"] for w in x)
        else:
            for y in x:
                yield from _leaves(y, named)
    elif isinstance(x, dict):
        low = {k.lower(): v for k, v in x.items()}
        if isinstance(low.get("text"), str):
            yield from _leaves(low["text"], True)
        elif "lines" in low:
            yield from _leaves(low["lines"], True)
        else:
            for k, v in low.items():
                yield from _leaves(v, k in TEXT_KEYS)


def from_json(data: bytes) -> Pages:
    x = json.loads(decode(data))
    pages = x.get("pages") if isinstance(x, dict) else x if isinstance(x, list) and all(isinstance(p, dict) for p in x) else None
    return [list(_leaves(p, True)) for p in pages] if isinstance(pages, list) and pages else [list(_leaves(x, True))]


class Noted(list):
    """Pages of which some could not be read: ``notes`` of (page, what was wrong)."""

    def __init__(self):
        super().__init__()
        self.notes: list[tuple[int, str]] = []


def jsonl(data: bytes) -> Pages:
    """A page for each record; a record that cannot be read is an empty page with a note."""
    out = Noted()
    for line in decode(data).splitlines():
        if line.strip():
            try:
                out.append(list(_leaves(json.loads(line), True)))
            except ValueError as e:
                out.append([])
                out.notes.append((len(out), f"record {len(out)}: {e}"[:300]))
    return out


def _tag(e) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def _all(e, *names):
    return [x for x in e.iter() if _tag(x) in names]


def _text(e) -> str:
    return re.sub(r"\s+", " ", "".join(e.itertext())).strip()


def parse_xml(data: bytes):
    """The root of an XML file; one that declares entities, anywhere and in any encoding, is refused."""

    def refuse(*_):
        raise ValueError("entity declarations are refused")

    check = expat.ParserCreate()
    check.EntityDeclHandler = refuse
    with contextlib.suppress(expat.ExpatError):  # the tree's own parser reports it
        check.Parse(data, True)
    return ET.fromstring(data)


def alto(root) -> Pages:
    """ALTO: blocks along their IDNEXT chain, hyphenated words as their whole form at the first part."""
    out = []
    for page in _all(root, "Page"):
        blocks = _all(page, "TextBlock")
        by_id = {b.get("ID"): b for b in blocks}
        following = {b.get("IDNEXT") for b in blocks}
        order, seen = [], set()
        for b in [b for b in blocks if b.get("ID") not in following] + blocks:
            while b is not None and id(b) not in seen:
                seen.add(id(b))
                order.append(b)
                b = by_id.get(b.get("IDNEXT"))
        lines = []
        for line in (x for b in order for x in _all(b, "TextLine")):
            words = [s.get("SUBS_CONTENT") if s.get("SUBS_TYPE") == "HypPart1" and s.get("SUBS_CONTENT") else s.get("CONTENT", "") for s in _all(line, "String") if s.get("SUBS_TYPE") != "HypPart2"]
            lines.append(" ".join(words))
        out.append(lines)
    return out


def page_xml(root) -> Pages:
    out = []
    for page in _all(root, "Page"):
        refs = {r.get("regionRef"): int(r.get("index", 0)) for r in _all(page, "RegionRefIndexed")}
        regions = sorted(_all(page, "TextRegion", "TableCell"), key=lambda r: refs.get(r.get("id"), 1 << 30))
        line = lambda x: next((_text(u) for e in x if _tag(e) == "TextEquiv" for u in _all(e, "Unicode")), "")
        out.append([line(t) for r in regions for t in [x for x in r if _tag(x) == "TextLine"] or [r]])
    return out


def tei(root) -> Pages:
    pages: Pages = [[""]]

    def walk(e):
        name = _tag(e)
        if name in ("teiHeader", "sic", "orig", "note"):
            return
        if name == "pb" and any(pages[-1]):
            pages.append([""])
        elif name in ("lb", "p", "l", "head", "div", "ab") and pages[-1][-1].strip():
            pages[-1].append("")
        pages[-1][-1] += e.text or ""
        for c in e:
            walk(c)
            pages[-1][-1] += c.tail or ""
        if name in ("p", "l", "head", "ab") and pages[-1][-1].strip():
            pages[-1].append("")

    walk(root)
    return [[re.sub(r"\s+", " ", x).strip() for x in p if x.strip()] for p in pages]


def abbyy(root) -> Pages:
    return [["".join(c.text or "" for c in _all(line, "charParams")) or _text(line) for line in _all(page, "line")] for page in _all(root, "page")]


def djvu(root) -> Pages:
    return [[" ".join(_text(w) for w in _all(line, "WORD")) for line in _all(page, "LINE")] for page in _all(root, "OBJECT")]


def xml(data: bytes) -> Pages:
    root = parse_xml(data)
    kind = {"alto": alto, "PcGts": page_xml, "TEI": tei, "teiCorpus": tei, "DjVuXML": djvu}.get(_tag(root))
    if kind is None and _tag(root) == "document" and _all(root, "charParams", "formatting"):
        kind = abbyy
    if _tag(root).lower() == "html":
        return html(data)
    return kind(root) if kind else [[x for e in root.iter() for x in (e.text or "", e.tail or "") for x in [re.sub(r"\s+", " ", x).strip()] if x]]


class _Flow(HTMLParser):
    """Lines of a web page: blocks break, scripts and styles go, hOCR pages and lines are kept."""

    SKIP = {"script", "style", "noscript", "template", "head"}
    BLOCK = set("address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.pages: Pages = [[]]
        self.now, self.skip = "", 0

    def _break(self):
        line = re.sub(r"\s+", " ", self.now).strip()
        if line:
            self.pages[-1].append(line)
        self.now = ""

    def handle_starttag(self, tag, attrs):
        classes = (dict(attrs).get("class") or "").split()
        if tag in self.SKIP:
            self.skip += 1
        if tag in self.BLOCK or "ocr_line" in classes:
            self._break()
        if "ocr_page" in classes and self.pages[-1]:
            self.pages.append([])

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.skip = max(0, self.skip - 1)
        if tag in self.BLOCK:
            self._break()

    def handle_data(self, data):
        if not self.skip:
            self.now += data


def html(data: bytes) -> Pages:
    flow = _Flow()
    flow.feed(decode(data))
    flow.close()
    flow._break()
    return flow.pages


def _zip_xml(data: bytes, *names: str):
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for pattern in names:
            number = lambda n: [int(x) for x in re.findall(r"\d+", n)]
            for n in sorted((n for n in z.namelist() if re.fullmatch(pattern, n)), key=number):
                if z.getinfo(n).file_size > MAX_BYTES:
                    raise ValueError("a member is too large")
                yield n, parse_xml(z.read(n))


def docx(data: bytes) -> Pages:
    pages: Pages = [[]]
    for _, root in _zip_xml(data, "word/document.xml"):
        for p in _all(root, "p"):
            line = ""
            for e in p.iter():
                if _tag(e) == "t":
                    line += e.text or ""
                elif _tag(e) == "tab":
                    line += "\t"
                elif _tag(e) == "br" and any(k.endswith("type") and v == "page" for k, v in e.attrib.items()):
                    pages[-1].append(line)
                    pages.append([])
                    line = ""
            pages[-1].append(line)
    return pages


def xlsx(data: bytes) -> Pages:
    shared = [_text(s) for _, root in _zip_xml(data, "xl/sharedStrings.xml") for s in _all(root, "si")]
    out = []
    for _, root in _zip_xml(data, r"xl/worksheets/sheet\d+\.xml"):
        rows = []
        for r in _all(root, "row"):
            cells = []
            for c in _all(r, "c"):
                v = next((x.text or "" for x in _all(c, "v")), "")
                cells.append(shared[int(v)] if c.get("t") == "s" and v else _text(c) if c.get("t") == "inlineStr" else v)
            rows.append("\t".join(cells))
        out.append(rows)
    return out


def pptx(data: bytes) -> Pages:
    return [["".join(t.text or "" for t in _all(p, "t")) for p in _all(root, "p")] for _, root in _zip_xml(data, r"ppt/slides/slide\d+\.xml")]


def odf(data: bytes) -> Pages:
    for _, root in _zip_xml(data, "content.xml"):
        sheets = _all(root, "table") if _all(root, "spreadsheet") else _all(root, "page")
        if sheets:
            rows = lambda s: [["\t".join(_text(c) for c in _all(r, "table-cell")) for r in _all(s, "table-row")] or [_text(p) for p in _all(s, "p")]][0]
            return [rows(s) for s in sheets]
        return [[_text(p) for p in _all(root, "p", "h")]]
    return []


def epub(data: bytes) -> Pages:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        opf = _all(parse_xml(z.read("META-INF/container.xml")), "rootfile")[0].get("full-path")
        root, base = parse_xml(z.read(opf)), opf.rpartition("/")[0]
        items = {i.get("id"): i.get("href") for i in _all(root, "item")}
        names = [items[r.get("idref")] for r in _all(root, "itemref") if r.get("idref") in items]
        return [[x for p in html(z.read(f"{base}/{n}" if base else n)) for x in p] for n in names]


def rtf(data: bytes) -> Pages:
    """RTF: groups of metadata skipped, \\par and \\line break lines, \\page pages, \\'hh and \\uN characters."""
    text, out, stack, skip, uc = data.decode("latin-1"), [[""]], [], False, 1
    code, drop = "cp1252", 0
    found = re.search(r"\\ansicpg(\d+)", text)
    code = f"cp{found[1]}" if found else code
    for m in re.finditer(r"\\([a-z]+)(-?\d+)? ?|\\'([0-9a-fA-F]{2})|\\([^a-z])|([{}])|([^\\{}\r\n]+)", text):
        word, number, byte, symbol, brace, run = m.groups()
        if brace == "{":
            stack.append((skip, uc))
        elif brace == "}":
            skip, uc = stack.pop() if stack else (False, 1)
        elif symbol == "*" or word in ("fonttbl", "colortbl", "stylesheet", "info", "pict", "header", "footer", "themedata", "generator"):
            skip = True
        elif skip:
            continue
        elif word in ("par", "line", "row"):
            out[-1].append("")
        elif word == "page":
            out.append([""])
        elif word in ("tab", "cell"):
            out[-1][-1] += "\t"
        elif word == "uc":
            uc = int(number or 1)
        elif word == "u":
            out[-1][-1] += chr(int(number) % 65536)
            drop = uc
        elif byte or (symbol and symbol in "\\{}~-_") or run:
            piece = bytes([int(byte, 16)]).decode(code, "replace") if byte else {"~": " ", "_": "-", "-": ""}.get(symbol, symbol) if symbol else run
            cut = min(drop, len(piece))
            drop -= cut
            out[-1][-1] += piece[cut:]
    return out


def subtitles(data: bytes) -> Pages:
    out = []
    for block in re.split(r"\n\s*\n", decode(data).replace("\r\n", "\n")):
        rows = block.strip().split("\n")
        at = next((i for i, r in enumerate(rows) if re.search(r"\d+:\d\d(?::\d\d)?[.,]\d{3}\s*-->", r)), None)
        if at is not None:
            out += [t for r in rows[at + 1 :] for t in [re.sub(r"<[^>]+>|\{\\[^}]*\}", "", r).strip()] if t]
    return [out]


def _message(m) -> list[str]:
    lines = [f"{k}: {m[k]}" for k in ("From", "To", "Date", "Subject") if m[k]]
    body = m.get_body(("plain", "html"))
    if body is not None:
        content = body.get_content()
        lines += html(content.encode())[0] if body.get_content_type() == "text/html" else content.rstrip("\n").split("\n")
    return lines


def mail(data: bytes) -> Pages:
    parts = [p for p in re.split(rb"(?m)^From .*\n", data) if p.strip()] if data.startswith(b"From ") else [data]
    return [_message(email.message_from_bytes(re.sub(rb"(?m)^>(>*From )", rb"\1", p), policy=email.policy.default)) for p in parts]


def bundle(data: bytes) -> Pages:
    """A ZIP of page files: members of the most common kind, in natural order, one or more pages each."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = [n for n in z.namelist() if not n.endswith("/") and not re.search(r"(^|/)(\.|__MACOSX|Thumbs\.db)", n)]
        total = sum(z.getinfo(n).file_size for n in names)
        if total > MAX_BYTES or total > 200 * max(len(data), 1 << 16):
            raise ValueError("the bundle is too large")
        kinds = {n: sniff(z.read(n), n) for n in names}
        read = {n: k for n, k in kinds.items() if k in READERS and k != "zip"}
        if not read:
            return []
        most = max(sorted(set(read.values())), key=list(read.values()).count)
        key = lambda n: [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.split(r"(\d+)", n) if x]
        return [p for n in sorted((n for n, k in read.items() if k == most), key=key) for p in READERS[most](z.read(n))]


READERS: dict[str, Callable[[bytes], Pages]] = {
    "text": plain, "markdown": markdown, "csv": table, "tsv": lambda d: table(d, "\t"), "tesseract": tesseract, "json": from_json, "jsonl": jsonl, "xml": xml, "html": html, "docx": docx, "xlsx": xlsx, "pptx": pptx, "odf": odf, "epub": epub, "rtf": rtf, "subtitles": subtitles, "email": mail, "zip": bundle,
}
EXTENSIONS = {"md": "markdown", "markdown": "markdown", "csv": "csv", "tsv": "tsv", "jsonl": "jsonl", "ndjson": "jsonl", "json": "json", "xml": "xml", "html": "html", "htm": "html", "xhtml": "html", "hocr": "html", "srt": "subtitles", "vtt": "subtitles", "eml": "email", "mbox": "email", "rtf": "rtf", "txt": "text"}


def unpacked(data: bytes) -> bytes:
    """The content of a compressed file, of at most ``MAX_BYTES``."""
    for mark, module in ((b"\x1f\x8b", gzip), (b"BZh", bz2), (b"\xfd7zXZ\x00", lzma)):
        if data.startswith(mark):
            with module.open(io.BytesIO(data)) as f:
                found = f.read(MAX_BYTES + 1)
            if len(found) > MAX_BYTES:
                raise ValueError("the file is too large when unpacked")
            return found
    return data


def sniff(data: bytes, name: str = "") -> str:
    """The kind of a file by content, then by extension; ``pdf`` and ``binary`` have no reader."""
    ext = name.lower().removesuffix(".gz").removesuffix(".bz2").removesuffix(".xz").rpartition(".")[2]
    if data.startswith(b"%PDF"):
        return "pdf"
    if data.startswith(b"{\\rtf"):
        return "rtf"
    if data.startswith(b"PK\x03\x04"):
        try:
            names = zipfile.ZipFile(io.BytesIO(data)).namelist()
        except zipfile.BadZipFile:
            return "binary"
        for part, kind in (("word/document.xml", "docx"), ("xl/workbook.xml", "xlsx"), ("ppt/presentation.xml", "pptx"), ("META-INF/container.xml", "epub"), ("content.xml", "odf")):
            if part in names:
                return kind
        return "zip"
    head = decode(data[:65536]).lstrip()
    if re.match(r"(?i)<!doctype html|<html", head):
        return "html"
    if head.startswith("<?xml") or re.match(r"<[A-Za-z][\w:.-]*[\s>]", head) and ext not in ("html", "htm", "md", "txt"):
        return "html" if re.search(r"(?i)<html[\s>]", head[:4096]) else "xml"
    if head.startswith("WEBVTT") or re.search(r"(?m)^\d\d:\d\d:\d\d[,.]\d{3} -->", head[:2000]):
        return "subtitles"
    if head.startswith("level\tpage_num"):
        return "tesseract"
    if ext in EXTENSIONS and ext not in ("txt", "json"):
        return EXTENSIONS[ext]
    if head[:1] in ("{", "["):
        try:
            json.loads(decode(data))
            return "json"
        except ValueError:
            rows = [r for r in head.split("\n")[:3] if r.strip()]
            if rows and all(r.lstrip().startswith("{") for r in rows):
                return "jsonl"
    if head.startswith("From ") or len(re.findall(r"(?m)^(?:From|To|Subject|Date|Message-ID|MIME-Version): ", head[:4000])) >= 3:
        return "email"
    if b"\x00" in data[:4096] and not data.startswith((b"\xff\xfe", b"\xfe\xff")):
        return "binary"
    return EXTENSIONS.get(ext, "text")


def parse(data: bytes, name: str = "", kind: str | None = None) -> tuple[str, Pages, str | None]:
    """(kind, pages, error) of a file; never raises."""
    try:
        if len(data) > MAX_BYTES:
            raise ValueError("the file is too large")
        data = unpacked(data)
        kind = kind or sniff(data, name)
        if kind not in READERS:
            raise ValueError(f"no reader for {kind}")
        pages = READERS[kind](data)
        found = Noted() if getattr(pages, "notes", None) else []
        found.extend([clean(x) for x in p] for p in pages)
        if isinstance(found, Noted):
            found.notes = pages.notes
        return kind, found, None
    except Exception as e:  # a bad file costs one row
        return kind or "unknown", [], f"{type(e).__name__}: {e}"[:300]


def _rows(file: str, data: bytes, kind: str | None):
    kind, pages, error = parse(data, file, kind)
    if error:
        yield file, kind, None, None, None, error
    for p, note in getattr(pages, "notes", ()):
        yield file, kind, p, None, None, note
    for p, lines in enumerate(pages, 1):
        for i, text in enumerate(lines, 1):
            yield file, kind, p, i, text, None


def read_files(spark: SparkSession, path: str, kind: str | None = None, glob: str = "*") -> DataFrame:
    """The line table of all files under a path (or one kind of them); hidden and lock files are ignored.

    ``file`` is the path below the given one, so files of one name in different folders stay apart. Of the rows of a file
    that cannot be read, or of a record of it, ``error`` says why.
    """
    root = re.sub(r"^[a-z0-9]+:/*", "/", path.rstrip("/")) + "/"
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    files = files.where(~F.col("path").rlike(r"/(?:\.|~\$|Thumbs\.db|desktop\.ini)[^/]*$")).select("path", "content")

    def below(f: str) -> str:
        at = f.find(root)
        return f[at + len(root) :] if at >= 0 else f.rpartition("/")[2]

    def run(batches):
        for b in batches:
            found = [r for f, c in zip(b["path"], b["content"], strict=True) for r in _rows(below(f), bytes(c), kind)]
            yield pd.DataFrame(found, columns=["file", "kind", "page_num", "line_num", "text", "error"]).astype({"page_num": "Int32", "line_num": "Int32"})

    return files.mapInPandas(run, SCHEMA)


def read_column(df: DataFrame, id_column: str, column: str, kind: str) -> DataFrame:
    """The line table of documents held in a text column."""
    rows = df.select(F.col(id_column).cast("string").alias("file"), F.col(column).alias("content"))

    def run(batches):
        for b in batches:
            found = [r for f, c in zip(b["file"], b["content"], strict=True) for r in _rows(f, (c or "").encode(), kind)]
            yield pd.DataFrame(found, columns=["file", "kind", "page_num", "line_num", "text", "error"]).astype({"page_num": "Int32", "line_num": "Int32"})

    return rows.mapInPandas(run, SCHEMA)
