"""Explicit schemas of the engine's tables.

Strings are never null in these tables: absent is the empty string. Every
table whose order carries meaning has an ordinal column.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


CONTENT = "row_no long, psr_id string, psr_content string, content_tag string, content string"
GROUP = "group_no long, group_id string, start_row long, composite string, rows array<long>, segment_rows array<long>, segments array<string>"
STORY = "file_no int, file_name string, xml string"
UNIT = "file_no int, pos long, psr_id string, content_id string, content string"
GLOSSARY = "kind string, source string, field string, value string, ord long"
ENTRY = "source string, target string, kind string, source_term string, ord long"
COMPILED = "source string, target string, kind string, source_term string, ord long, contextual boolean, alternatives array<struct<target:string,source_term:string>>, folded string, allow_ci boolean"
PUBLISHED = "book string, row int, kind string, english string, english_definition string, translations map<string,struct<term:string,definition:string,combined_definition:string>>"
RULES = "book string, scope string, rule_type string, id string, pattern string, flags string, message string"
ISSUE = "row_no long, column_no int, content_id string, severity string, code string, message string, details map<string,string>"
LEDGER = "book string, diagram_order int, file string, relative_path string, bytes long, sha256 string, units array<struct<id:string,font:string,kind:string,text:string,plain:string,translations:map<string,string>>>"
CAPTION = "row_no long, image string, english string, spanish string, french string, portuguese string, german string"
PROTECTED = "content_id string, source_text string, sha256 string, relative_path string, style string"
AUDIT = "line_no long, kind string, fields map<string,string>"
TYPOGRAPHY = "trim_size string, style_tree1 string, style_tree2 string, paragraph_style string, language string, book string, size double, leading double, alternatives array<double>, source_cell string"
BLOCKS = "array<struct<type:string,text:string,delimiter:string>>"
JOB = "job_id string, book string, language string, profile string, status string, created string, config map<string,string>"
LOCK = "token string, source string, target string, segment_index int, kind string"
PREPARED = "ord long, group_id string, segments array<string>, locks array<struct<token:string,source:string,target:string,segment_index:int,kind:string>>"
SCAN_RUN = "file string, run_no int, id string, frame_index int, start int, length int, original_text string"
CONTENT_HEADERS = ["ParagraphStyleRange id", "ParagraphStyleRange content", "Content tag", "Content content"]


def schema(ddl: str) -> T.StructType:
    """StructType of one of the definitions above."""
    return _struct(ddl)
