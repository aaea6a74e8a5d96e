"""Schemas of what the engine writes."""

REFS = "array<struct<ref_type:string,raw_text:string,target_section_no:string,target_chunk_id:string,resolved:boolean>>"
BACKLINKS = "array<struct<src_chunk_id:string,ref_type:string,raw_text:string>>"
MENTIONS = "array<struct<name:string,source:string,canonical_id:string>>"
CHUNK = (
    "doc_id long, order int, chunk_id string, title string, breadcrumb string, section_no string, level int, part int, n_parts int, token_count int, text string, "
    f"page_start int, page_end int, source_path string, original_name string, refs_out {REFS}, refs_in {BACKLINKS}, mentioned_entities {MENTIONS}"
)
EDGE = "doc_id long, edge_ord long, src_chunk_id string, dst_chunk_id string, edge_type string, ref_text string, resolved boolean, weight double"
ALIAS = "name string, name_key string, canonical string, canonical_key string, id string"
