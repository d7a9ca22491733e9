"""Schemas of the relations and the fixed values of the capped source."""

from __future__ import annotations

#: A search shows at most this many rows.
CAP = 30
#: A paged table has at most this many pages.
MAX_PAGES = 500
#: A failure stays retryable while fewer attempts than this were made.
MAX_ATTEMPTS = 3
#: Filters of two short fragments that cover most names, in the order of their worth. Fixed values.
FILTERS = ["DA S", "OS S", "NT O", "ES A", "RA S", "AN A", "IN A", "RI A", "DO S", "CO S", "TE S", "AL V", "UZ A", "DE A", "ER A"]
#: Events that say a window is done.
FINAL_EVENTS = ["window", "unsplittable", "covered", "abandoned"]
#: HTTP states and network errors after which a request is tried again. Fixed values.
RETRYABLE_STATUS = [429, 502, 503, 504]
TRANSIENT_CODES = ["ECONNRESET", "ECONNREFUSED", "ETIMEDOUT", "EAI_AGAIN", "EPIPE", "UND_ERR_SOCKET"]



def _struct(ddl: str) -> str:
    return f"struct<{ddl}>"


PARTY_DDL = _struct("name:string,role:string,document:struct<kind:string,value:string>,oab:string,status:string")
MOVEMENT_DDL = _struct("date:string,description:string")
DOWNLOAD_DDL = _struct("idBin:string,numeroDocumento:string,nomeArqProcDocBin:string,idProcessoDocumento:string,actionMethod:string")
DOCUMENT_DDL = _struct(f"date:string,name:string,kind:string,download:{DOWNLOAD_DDL},localPath:string")
WINDOW_DDL = _struct("`from`:string,`to`:string,judicialClassId:string,judicialClassName:string,partyName:string")
HEADER_FIELDS = ["judicialClass", "subject", "filingDate", "jurisdiction", "court", "judgingBody", "address", "referenceCase"]

#: DDL of each persisted relation; seq is the append order.
RELATIONS = {
    "search_rows": "number string, ca string, judicialClass string, subject string, parties string, lastMovement string, seq bigint",
    "dequeued": "number string, seq bigint",
    "cases": "number string, ca string, " + ", ".join(f"{f} string" for f in HEADER_FIELDS)
    + f", activeParties array<{PARTY_DDL}>, passiveParties array<{PARTY_DDL}>, movements array<{MOVEMENT_DDL}>, documents array<{DOCUMENT_DDL}>"
    + ", sealed boolean, extractedAt string, seq bigint",
    "sweep_progress": f"type string, query {WINDOW_DDL}, depth int, cnjNumbers array<string>, filtersTried int, unionSize int, recordedAt string, seq bigint",
    "failed_documents": "type string, key string, reason string, httpStatus int, attempt int, retryable boolean, "
    f"detail struct<caseNumber:string,documentId:string,downloadRef:{DOWNLOAD_DDL}>, recordedAt string, seq bigint",
    "failed_cases": "type string, key string, reason string, httpStatus int, attempt int, retryable boolean, "
    "detail struct<caseNumber:string,ca:string>, recordedAt string, seq bigint",
    "class_catalog": "id string, name string, ord int",
    "pages": "case_number string, table_id string, page int, html string",
}
