"""The upload source: DOCX bodies, damaged files, partitions, and the upload pipeline fed from it."""

import io
import zipfile

from docfold.operators import workflows
from docfold.operators.matching import LexicalProvider
from docfold.sources import uploads


def docx(body):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(uploads.BODY, f'<w:document xmlns:w="{uploads._W[1:-1]}" xmlns:x="y"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def test_paragraphs():
    """Runs, links, tabs, breaks and entities are text; tables, text boxes, deleted runs and settings are not; blank paragraphs go."""
    t = lambda x: f"<w:r><w:t>{x}</w:t></w:r>"
    body = (
        f"<w:p><w:pPr><w:tabs><w:tab/></w:tabs></w:pPr>{t('A &amp; b')}<w:hyperlink>{t(' link')}</w:hyperlink><w:r><w:tab/><w:t>c</w:t><w:br/><w:t>d</w:t></w:r></w:p>"
        f"<w:p>{t('  ')}</w:p><w:tbl><w:tr><w:tc><w:p>{t('cell')}</w:p></w:tc></w:tr></w:tbl>"
        f"<w:p>{t('kept')}<w:del>{t('gone')}</w:del><w:r><w:drawing><w:txbxContent><w:p>{t('boxed')}</w:p></w:txbxContent></w:drawing></w:r>{t(' too')}</w:p><w:p/><w:sectPr/>"
    )
    assert uploads.docx_text(docx(body)) == "A & b link\tc\nd\n\nkept too"
    assert uploads.docx_text(docx("")) == "" and uploads.docx_text(uploads.docx_bytes(["é <x>", "", "b"])) == "é <x>\n\nb"
    assert len(uploads.docx_text(uploads.docx_bytes(["word " * 20] * 20_000))) == 20_000 * 102 - 2


def test_source(spark, tmp_path, monkeypatch):
    """A damaged file is a row with its error; other files of its partition are read."""
    folder = tmp_path / "in"
    (folder / "deep").mkdir(parents=True)
    text = ["Banks shall keep records of all payments. " * 4, "They must report."]
    whole = uploads.docx_bytes(text)
    for name, content in {"good.docx": whole, "cut.docx": whole[: len(whole) // 2], "empty.docx": b"", "deep/note.TXT": "é".encode() + b"\xff", "x.pdf": b"%PDF", "none": b"x"}.items():
        (folder / name).write_bytes(content)
    bad = io.BytesIO()
    with zipfile.ZipFile(bad, "w") as z:
        z.writestr("other.xml", "<a/>")
    (folder / "no_body.docx").write_bytes(bad.getvalue())
    (folder / "bad_xml.docx").write_bytes(docx("<w:p>").replace(b"x", b"y"))
    uploads.register(spark)
    df = spark.read.format("uploads").load(str(folder))
    got = {r.filename: r for r in df.collect()}
    assert {k: r.status for k, r in got.items()} == {"good.docx": "read", "cut.docx": "failed", "empty.docx": "failed", "note.TXT": "read", "x.pdf": "unsupported", "none": "unsupported", "no_body.docx": "failed", "bad_xml.docx": "failed"}
    assert got["good.docx"].content_text == "\n\n".join(text) and got["note.TXT"].content_text == "é�" and all((r.error is not None) == (r.status == "failed") for r in got.values())
    reader = uploads.UploadReader(str(folder))
    monkeypatch.setattr(uploads, "PARTITION", 1)
    assert len(reader.partitions()) == 8
    (tmp_path / "void").mkdir()
    assert spark.read.format("uploads").load(str(tmp_path / "void")).count() == 0

    given = df.where("status <> 'unsupported'").selectExpr("filename", "'r' as regulator", "content_text", "'' as title", "'2020-01-02' as published_date")
    library = spark.createDataFrame([(1, "they must report")], "item_id long, text string")
    out = workflows.upload_pipeline(given, LexicalProvider(), library, 10)
    told = {r.filename: (r.status, r.n_obligations) for r in out["summary"].collect()}
    assert told["good.docx"] == ("accepted", 2) and told["cut.docx"] == ("too_short", None)
