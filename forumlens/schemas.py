"""Fixed record layouts."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "boolean": T.BooleanType(),
    "long": T.LongType(),
    "string": T.StringType(),
}


def _record(fields: str) -> T.StructType:
    pairs = (field.split(":") for field in fields.split())
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in pairs])


# Field names and types of the two input records, in file order.
COMMENTS = _record(
    """
    archived:boolean author:string author_flair_css_class:string author_flair_text:string
    body:string controversiality:long created_utc:string distinguished:string downs:long
    edited:string gilded:long id:string link_id:string name:string parent_id:string
    retrieved_on:long score:long score_hidden:boolean subreddit:string subreddit_id:string
    ups:long
    """
)
SUBMISSIONS = _record(
    """
    archived:boolean author:string author_flair_css_class:string author_flair_text:string
    created:long created_utc:string distinguished:string domain:string downs:long edited:boolean
    from:string from_id:string from_kind:string gilded:long hide_score:boolean id:string
    is_self:boolean link_flair_css_class:string link_flair_text:string media:string name:string
    num_comments:long over_18:boolean permalink:string quarantine:boolean retrieved_on:long
    saved:boolean score:long secure_media:string selftext:string stickied:boolean subreddit:string
    subreddit_id:string thumbnail:string title:string ups:long url:string
    """
)

DOCUMENTS = _record("id:string comments:string")
DOCUMENT_PARTS = _record("id:string comments:string part:long")
UPS_BOARD = _record("id:string ups:long")
COUNT_BOARD = _record("id:string comm_count:long")
RATIO_BOARD = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("comm_ups_ratio", T.DoubleType())]
)
DISTRIBUTIONS = _record("id:string topicDistribution:string")
