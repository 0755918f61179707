"""The eight check packages."""

from sievemark.packages import bom, doc_relation, document, item, name_desc, ownership, status, supersede

PACKAGES = {m.PACKAGE.name: m.PACKAGE for m in (item, document, doc_relation, bom, supersede, status, ownership, name_desc)}

# Staged table of each package among the sample views.
SAMPLE_INPUTS = {
    "item": "stg_item",
    "document": "stg_doc",
    "doc_relation": "stg_docrel",
    "bom": "stg_bom",
    "supersede": "stg_supersede",
    "status": "stg_status",
    "ownership": "stg_owner",
    "name_desc": "stg_namedesc",
}
