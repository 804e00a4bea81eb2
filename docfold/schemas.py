"""Record types and the value orders that rollups depend on."""

from pyspark.sql import types as T

_S, _L, _I, _B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


ANNEXURE = struct(title=_S, url=_S)
EXTRA_META = struct(
    org_pdf_text=_S, org_pdf_link=_S, arabic_pdf_link=_S, urdu_url=_S, content_text=_S, monitoring_status=_S, existing_regulation_id=_L, annexures=T.ArrayType(ANNEXURE)
)
DOCUMENT = struct(
    id=_L, regulator=_S, source_system=_S, category=_S, title=_S, document_url=_S, published_date=_S, reference_no=_S, year=_S,
    department=T.ArrayType(_S), doc_path=T.ArrayType(_S), source_page_url=_S, document_html=_S, content_hash=_S, type=_S, status=_S, extra_meta=EXTRA_META,
)
MATCH_VERDICT = struct(match_status=_S, matched_id=_L, explanation=_S)

# Most important first; the last is the default where nothing is given.
CRITICALITY = ("High", "Medium", "Low")
EXECUTION = ("Ongoing_Control", "One_Time_Implementation", "One_Off_Reporting", "Governance_Approval", "Informational_No_Action")
MATCH = ("new", "partially_matched", "fully_matched")
COVERAGE = ("covered", "partial", "missing")
DOCUMENT_STATUS = ("active", "superseded", "draft", "archived", "withdrawn")
