"""Uploads as a data source: ``spark.read.format("uploads").load(folder)`` gives a row for each file, with its text or why there is none.

Files are dealt to partitions by size.  A DOCX file's body is read part by part with a streaming XML parser, so memory is bounded by its longest
paragraph; text files are decoded.  A file that cannot be read is a row that says so, and takes no other with it.  The folder is any that
pyarrow's file systems open; where only Spark's readers reach it, ``docx_text`` reads the bytes that ``binaryFile`` gives.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "path string, filename string, extension string, length long, status string, content_text string, error string"
#: Bytes of files that make a partition.
PARTITION = 64 << 20
BODY = "word/document.xml"
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_BREAKS = {f"{_W}tab": "\t", f"{_W}br": "\n", f"{_W}cr": "\n", f"{_W}noBreakHyphen": "-"}


def docx_paragraphs(file) -> Iterator[str]:
    """The texts of the paragraphs that stand in the body itself, not in its tables; each is forgotten when it has been given."""
    with zipfile.ZipFile(file) as parts, parts.open(BODY) as body:
        around: list[ElementTree.Element] = []
        text: list[str] = []
        for event, e in ElementTree.iterparse(body, events=("start", "end")):
            if event == "start":
                around.append(e)
                continue
            around.pop()
            in_body = len(around) >= 3 and around[1].tag == f"{_W}body" and around[2].tag == f"{_W}p" or len(around) == 2 and e.tag == f"{_W}p"
            if in_body and not any(x.tag in (f"{_W}del", f"{_W}txbxContent", f"{_W}pPr") for x in around):
                text.append((e.text or "") if e.tag == f"{_W}t" else _BREAKS.get(e.tag, ""))
            if len(around) == 2:  # a paragraph, a table or the section's end
                if e.tag == f"{_W}p":
                    yield "".join(text)
                text = []
                around[-1].remove(e)


def docx_text(content) -> str:
    """Paragraphs that are not blank, with an empty line between them; ``content`` is bytes or a file."""
    file = io.BytesIO(content) if isinstance(content, bytes) else content
    return "\n\n".join(p for p in docx_paragraphs(file) if p.strip())


def _text(file) -> str:
    return file.read().decode("utf-8", "replace")


READERS = {"docx": docx_text, "txt": _text, "md": _text}


class Files(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


class UploadReader(DataSourceReader):
    def __init__(self, path: str):
        self.uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
        self.uri = self.uri.replace("file:///", "file:/").replace("file:/", "file:///")

    def partitions(self) -> list[Files]:
        system, root = fs.FileSystem.from_uri(self.uri)
        found = sorted((f.path, f.size) for f in system.get_file_info(fs.FileSelector(root, recursive=True)) if f.is_file)
        out: list[list[tuple[str, int]]] = [[]]
        held = 0
        for path, size in found:
            if out[-1] and held + size > PARTITION:
                out.append([])
                held = 0
            out[-1].append((path, size))
            held += size
        return [Files(files) for files in out]

    def read(self, partition: Files) -> Iterator[tuple]:
        system, _ = fs.FileSystem.from_uri(self.uri)
        for path, size in partition.files:
            name = path.rsplit("/", 1)[-1]
            ending = name.rsplit(".", 1)[-1].lower() if "." in name else ""
            status, text, error = "read", None, None
            if ending not in READERS:
                status = "unsupported"
            else:
                try:
                    with system.open_input_file(path) as file:
                        text = READERS[ending](file)
                except Exception as e:  # noqa: BLE001 - whatever a file does, the others are read
                    status, error = "failed", f"{type(e).__name__}: {e}"[:500]
            yield path, name, ending, size, status, text, error


class UploadSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "uploads"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> UploadReader:
        return UploadReader(self.options["path"])


def register(spark) -> None:
    """Makes ``format("uploads")`` known to a session."""
    spark.dataSource.register(UploadSource)


def docx_bytes(paragraphs: list[str]) -> bytes:
    """A DOCX file of plain paragraphs."""
    from xml.sax.saxutils import escape

    body = "".join(f'<w:p><w:r><w:t xml:space="preserve">{escape(p)}</w:t></w:r></w:p>' for p in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"/>')
        z.writestr(BODY, f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="{_W[1:-1]}"><w:body>{body}<w:sectPr/></w:body></w:document>')
    return out.getvalue()
