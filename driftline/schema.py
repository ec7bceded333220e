"""Schemas shared by sources, operators and sinks."""

from pyspark.sql import types as T

CONTEXT = T.StructType([T.StructField(n, T.StringType()) for n in ("story_type", "character", "chapter")])

ITEM = T.StructType(
    [
        *(T.StructField(n, T.StringType()) for n in ("uid", "category", "file")),
        T.StructField("line", T.IntegerType()),
        *(T.StructField(n, T.StringType()) for n in ("command", "field", "record_id", "jp", "existing_cn", "status", "speaker")),
        T.StructField("file_context", CONTEXT),
        T.StructField("cn", T.StringType()),
        T.StructField("rec_idx", T.IntegerType()),
        T.StructField("ord", T.LongType()),
    ]
)

SNAPSHOT = "uid string, jp string"
CHECKPOINT = "uid string, jp_sha string, cn string"
CATEGORIES = ("resource", "master", "generic", "localization")
MASTER_RECORD = "map<string,string>"  # values as JSON text, so that 1 and "1" differ

# Fixed values, needed for equal results: character keys of script names, labels of story types, and names by key.
CHARACTER_KEYS = ("amao", "hski", "hume", "fktn", "kllj", "hrnm", "shro", "ssmk", "ttmr", "kcna", "hmsz", "atbm", "jsna", "cmmn")
STORY_LABELS = {
    "dear": "亲密度故事", "cidol": "偶像剧情", "event": "活动剧情", "gasha": "卡池", "live": "演唱会", "pevent": "P活动",
    "pgrowth": "P增长", "presult": "P结果", "produce": "培育", "pstep": "P步骤", "pstory": "P剧情", "pweek": "P周常",
    "startup": "启动", "tutorial": "教程", "tower": "塔", "unit": "团体", "warmup": "热身", "csprt": "支援",
}
