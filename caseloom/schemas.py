"""Explicit schemas; nothing is inferred at read time."""

from pyspark.sql import types as T

TWEETS = T.StructType(
    [
        T.StructField("tweet_id", T.LongType()),
        T.StructField("author_id", T.StringType()),
        T.StructField("inbound", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("response_tweet_id", T.StringType()),
        T.StructField("in_response_to_tweet_id", T.LongType()),
    ]
)

TOP_INTENTS = "array<struct<intent:string,probability:double>>"

TOP_CASES = (
    "array<struct<case_id:string,customer_tweet_id:string,customer_message:string,"
    "brand_reply:string,n_replies:bigint,intent:string,similarity_score:double,conversation_id:string>>"
)
