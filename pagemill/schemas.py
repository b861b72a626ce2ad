"""Types shared by the stages."""

from __future__ import annotations

# What a parser returns: pages by position, elements with the boxes they were seen in.
BBOX = "STRUCT<coord: ARRAY<INT>, page_id: INT>"
PAGE = "STRUCT<id: INT, image_uri: STRING>"
ELEMENT = f"STRUCT<id: INT, type: STRING, content: STRING, description: STRING, bbox: ARRAY<{BBOX}>>"
PARSED = f"STRUCT<document: STRUCT<pages: ARRAY<{PAGE}>, elements: ARRAY<{ELEMENT}>>>"

# Source rows. Only the first three columns are read; the audit time comes with the scan.
FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"

PARSED_DOCS = (
    "file_name STRING, file_path STRING, file_size BIGINT, document_type STRING, "
    "encrypted_parsed_doc STRING, ingested_at TIMESTAMP"
)
ELEMENTS = (
    "file_name STRING, file_path STRING, document_type STRING, element_id INT, element_type STRING, "
    "encrypted_content STRING, description STRING, page_id INT, image_uri STRING, bbox_json STRING, "
    "extracted_at TIMESTAMP"
)
PAGE_KEY = ["file_name", "file_path", "document_type", "page_id"]
GOLD = [
    "chunk_id", "file_name", "file_path", "document_type", "page_id",
    "page_content_masked", "element_count", "element_types", "image_uri",
]

GOLD_ROWS = (
    "chunk_id STRING, file_name STRING, file_path STRING, page_id INT, page_content_masked STRING, element_count BIGINT, "
    "element_types STRING, image_uri STRING, document_type STRING"
)
PAGE_ROWS = (
    "file_name STRING, file_path STRING, document_type STRING, page_id INT, encrypted_page_content STRING, element_count BIGINT, "
    "element_types STRING, image_uri STRING, extracted_at TIMESTAMP, aggregated_at TIMESTAMP"
)

WORD = "STRUCT<text: STRING, x0: DOUBLE, y0: DOUBLE, x1: DOUBLE, y1: DOUBLE, fontname: STRING, fontsize: DOUBLE>"
ENTITY = "STRUCT<original: STRING, masked: STRING, category: STRING>"

# The categories that are published, and above the columns of published pages and of a page's key.
CATEGORIES = ["hr", "finance", "research", "engineering", "support"]
