import pytest
from pyspark.sql import functions as F

from caseloom.operators import similarity as S
from caseloom.session import store
from caseloom.sources import segments

SCHEMA = "customer_tweet_id long, brand_tweet_id long, case_id string, conversation_id string, intent string, customer_message string, brand_reply string"


def case(doc, reply, message):
    return (doc, reply, f"CASE_{doc}", str(doc), "other", message, f"reply {reply}")


FIRST = [case(1, 11, "late parcel refund"), case(2, 21, "lost parcel"), case(3, 31, "broken screen refund please"), case(9, 95, "odd words here")]
#: more replies to 1 and 2, one earlier than the ones before, and another text for 9 that comes first
SECOND = [case(4, 41, "parcel came late"), case(1, 12, "late parcel refund"), case(2, 20, "lost parcel"), case(9, 91, "parcel words again")]
THIRD = [case(5, 51, "refund the broken phone"), case(6, 61, "lost parcel"), case(7, 71, None), case(2, 22, "lost parcel")]


def content(index):
    """All that the tables hold, whatever their order."""
    return {
        "cases": sorted(map(str, index.cases.select(sorted(index.cases.columns)).collect())),
        "replies": sorted(map(str, index.replies.select("doc_id", "reply_order", "brand_reply").collect())),
        "vocab": sorted(map(str, index.vocab.select("term", "frequency", "df", F.round("idf", 9)).collect())),
        "members": sorted(map(str, index.members.select("doc_id", "vec_id").collect())),
        "postings": sorted(map(str, index.postings.select("vec_id", "term", F.round("weight", 9), "df", "level").collect())),
        "blocks": sorted(map(str, index.blocks.select("term", "level", F.round("top", 9), "n").collect())),
    }


def test_segments_hold_what_one_index_would(spark, rows, tmp_path):
    path = str(tmp_path / "index")
    assert segments.open_index(spark, path) is None
    names, so_far = [], []
    for part in (FIRST, SECOND, THIRD):
        names.append(segments.append(path, rows(part, SCHEMA), ("the",)))
        so_far += part
    want = content(S.build_index(rows(so_far, SCHEMA), ("the",), keep=store))
    assert content(segments.open_index(spark, path)) == want
    assert segments.segments(spark, path) == sorted(names)
    one = segments.merge(spark, path, names[:2])
    assert segments.segments(spark, path) == sorted([one, names[2]])
    assert content(segments.open_index(spark, path)) == want
    with pytest.raises(ValueError):
        segments.merge(spark, path, names[:1])
    segments.append(path, rows([], SCHEMA))
    segments.merge(spark, path)
    assert len(segments.segments(spark, path)) == 1
    last = segments.open_index(spark, path)
    assert content(last) == want and last.stop_words == ("the",)
