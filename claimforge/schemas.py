"""Schemas of the engine's tables."""

from __future__ import annotations

RELATION_ITEM = "array<struct<id:string,class:string,objects:array<struct<class:string>>>>"
VERTEX = f"struct<id:string, class:string, visible:boolean, bbox:array<double>, attention:{RELATION_ITEM}, contact:{RELATION_ITEM}, spatial:{RELATION_ITEM}, verb:{RELATION_ITEM}>"
#: A raw scene graph: entries by key, as read from JSON lines or Parquet.
RAW = (
    "video_id string, entries map<string, struct<type:string, id:string, secs:double, metadata:string, "
    f"vertices:array<{VERTEX}>, "
    "charades:string, phrase:string, start:double, `end`:double, all_f:array<string>, object_id:string, verb_id:string>>"
)
SEMANTICS = "struct<canonical_type:string,subject:string,predicate:string,object:string,polarity:string,temporal_relation:string,event_a:string,event_b:string>"
OPTION = f"struct<text:string,truth_state:string,label:tinyint,semantics:{SEMANTICS}>"
#: What the sink writes, column by column.
SINK = (
    "example_id string, split string, video_id string, query string, options array<string>, labels array<tinyint>, truth_state string, "
    "option_count int, task_type string, reasoning_family string, generator_family string"
)
