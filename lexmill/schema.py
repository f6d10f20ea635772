"""Table schemas. Every read uses one of these; nothing is inferred."""

from __future__ import annotations

COMMITTEE = "struct<committee_name:string,committee_role:string,committee_date:string>"
ORIGINATOR = "struct<originator_name:string,originator_affiliation:string>"
STAGE = "struct<number:int,name:string,date:string,house:string,debate_size:bigint,debate_url:string>"
AMENDMENT = (
    "struct<amendment_id:string,amendment_stage_name:string,amendment_stage_number:int,amendment_date:string,"
    "amendment_plenary:string,amendment_originator:array<string>,amendment_originator_aff:string,"
    "amendment_committee_name:string,amendment_text_url:string,amendment_text:string,amendment_text_size:bigint,"
    "amendment_outcome:string,amendment_vote_for:string,amendment_vote_against:string,amendment_vote_abst:string,"
    "amendment_page_link:string>"
)

PAGES = "country string, url string, kind string, html string"
DOC_TEXTS = "collection string, url string, size bigint, extracted_text string, text_size bigint"
TABLE_CELLS = "url string, page int, table_no int, `row` int, col int, text string"
MEMBERS = "house string, page_id string, parsed_name string, parsed_affiliation string"
AMENDMENT_FILE_COLUMNS = ("Numéro de l'amendement", "Etape du texte", "Titre complet", "Auteur", "Cosignataire(s)",
                          "Sort de l'amendement", "URL Amendement")
LAW_TYPES = "legislature int, law_type string, title string"

RECORD_FIELDS = {
    "record_id": "string", "country": "string", "bill_page_url": "string", "bill_id": "string", "bill_title": "string",
    "original_law": "boolean", "bill_status": "string", "law_id": "string", "origin_type": "string",
    "originators": f"array<{ORIGINATOR}>", "bill_type": "string", "date_introduction": "string",
    "date_committee": "string", "date_passing": "string", "date_entering_into_force": "string",
    "procedure_type_standard": "string", "procedure_type_national": "string",
    "legislative_stages": f"array<{STAGE}>", "stages_count": "int", "plenary_size": "bigint",
    "committees": f"array<{COMMITTEE}>", "committee_count": "int", "committee_hearing_count": "int",
    "committees_depth": "bigint", "modified_laws": "array<string>", "modified_laws_count": "int",
    "affecting_laws": "array<string>", "affecting_laws_count": "bigint", "affecting_laws_first_date": "string",
    "bill_text_url": "string", "bill_size": "bigint", "bill_text": "string", "law_text_url": "string",
    "law_size": "bigint", "law_text": "string", "amendments": f"array<{AMENDMENT}>", "amendment_count": "int",
    "amendment_links": "array<string>", "ia_dummy": "boolean", "ia_title": "string", "ia_text_url": "string",
    "ia_text": "string", "ia_date": "string", "ia_size": "bigint", "final_vote_for": "string",
    "final_vote_against": "string", "final_vote_abst": "string", "committee_hearing_count_external": "int",
    "law_text_footer": "string", "modified_laws_pdf_url": "string", "origin_type_detail": "string",
    "policy_area": "string", "leading_committee_name": "string", "final_version_printed_matter_id": "string",
    "final_votes_pdf_url": "string", "ia_text1": "string", "ia_text2": "string", "ia_size1": "bigint",
    "ia_size2": "bigint",
}
RECORDS = ", ".join(f"{name} {kind}" for name, kind in RECORD_FIELDS.items())

# Columns of the ten exported tables, in order.
EXPORT_COLUMNS = {
    "originators": ["record_id", "originator_name", "originator_affiliation"],
    "committees": ["record_id", "committee_name", "committee_role", "committee_date"],
    "modified_laws": ["record_id", "modified_law_id", "modified_record_id"],
    "affecting_laws": ["record_id", "affecting_law_id", "affecting_record_id"],
    "legislative_stages": ["record_id", "number", "name", "date", "house", "debate_size"],
    "amendments": ["record_id", "amendment_id", "amendment_stage_name", "amendment_stage_number",
                   "amendment_originator", "amendment_originator_aff", "amendment_committee_name", "amendment_text",
                   "amendment_text_url", "amendment_text_size", "amendment_plenary", "amendment_vote_for",
                   "amendment_vote_against", "amendment_vote_abst", "amendment_outcome"],
    "bill_main_table": ["record_id", "bill_page_url", "bill_id", "bill_title", "bill_status", "law_id", "origin_type",
                        "bill_type", "date_introduction", "date_committee", "date_passing",
                        "date_entering_into_force", "procedure_type_standard", "procedure_type_national",
                        "stages_count", "plenary_size", "committee_count", "committee_hearing_count",
                        "committee_hearing_count_external", "committees_depth", "modified_laws_count",
                        "affecting_laws_count", "affecting_laws_first_date", "bill_text_url", "bill_size",
                        "law_text_url", "law_size", "amendment_count", "ia_dummy", "original_law", "final_vote_for",
                        "final_vote_against", "final_vote_abst"],
    "bill_text": ["record_id", "bill_text"],
    "law_text": ["record_id", "law_text"],
    "impact_assessments": ["record_id", "ia_title", "ia_text_url", "ia_text", "ia_size", "ia_size1", "ia_size2",
                           "ia_text1", "ia_text2", "ia_date"],
}
