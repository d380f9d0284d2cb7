import json
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from murmur.functions.deep_json import comments_of
from murmur.operators.nested import flatten_comment_tree, unreadable_payloads


def comment(cid, body, replies=(), **more):
    children = [{"kind": "t1", "data": r} for r in replies]
    return {"id": cid, "body": body, **more, "replies": {"data": {"children": children}} if replies else ""}


def walk(node, out):
    """The comments of a tree, by recursion."""
    out.append((node.get("id"), node.get("parent_id"), node.get("body")))
    replies = node.get("replies")
    for child in replies["data"]["children"] if isinstance(replies, dict) else []:
        walk(child["data"], out)
    return out


def tree(rng, depth):
    replies = [tree(rng, depth - 1) for _ in range(rng.randint(0, 3))] if depth else []
    body = rng.choice(["x", 'quo"te', "back\\slash", "é😀\n", "", "}{][,:", None])
    return comment(f"c{rng.random()}", body, replies, **({"parent_id": f"t{depth}"} if depth % 2 else {}))


@pytest.mark.parametrize("seed", range(30))
@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_scan_equals_recursion(seed, style):
    root = tree(random.Random(seed), 5)
    payload = json.dumps(root, **style)
    got = comments_of(payload)
    assert [(c["id"], c["parent_id"], c["body"]) for c in got] == walk(root, [])
    for c in got:
        assert json.loads(payload[c["start"] : c["end"]])["id"] == c["id"]


JSON = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False) | st.text(max_size=5),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=3), inner, max_size=3),
    max_leaves=12,
)


@settings(max_examples=300, deadline=None)
@given(JSON, st.integers(0, 60), st.sampled_from(["", "x", "}", "]", ",", '"', "\\", "0", ":", " ", "\x01", "nul"]))
def test_json_and_nothing_else_is_taken(value, at, junk):
    text = json.dumps(value)
    at = min(at, len(text))
    text = text[:at] + junk + text[at + (len(junk) % 2) :]
    try:
        json.loads(text, parse_constant=lambda c: 1 / 0)
        valid = True
    except (ValueError, ZeroDivisionError):
        valid = False
    assert (comments_of(text) is not None) == valid


def chain(depth):
    return "".join(
        f'{{"id":"c{i}","body":"b{i}","replies":{{"data":{{"children":[{{"kind":"t1","data":' for i in range(depth)
    ) + '{"id":"leaf","body":"end","replies":""}' + "}]}}}" * depth


def test_time_is_linear_in_depth():
    times = []
    for depth in (5_000, 20_000):
        begin = time.process_time()
        assert len(comments_of(chain(depth))) == depth + 1
        times.append(time.process_time() - begin)
    assert times[1] < 8 * times[0]


def test_five_thousand_levels_come_out_whole(spark):
    rng = random.Random(1)
    rows = [("deep", chain(5000)), ("flat", json.dumps(tree(rng, 4))), ("broken", chain(5000)[:-1]), ("bad", "{")]
    frame = spark.createDataFrame([(p, 7, j) for p, j in rows], "post_id string, at int, payload string")
    got = flatten_comment_tree(frame, keep=("at",)).select("post_id", "position", "id", "parent_id", "comment_text", "at")
    deep = sorted(tuple(r)[1:] for r in got.where("post_id = 'deep'").collect())
    assert [r[1] for r in deep] == [*(f"c{i}" for i in range(5000)), "leaf"]
    assert {r[2] for r in deep} == {"deep"} and deep[-1][3:] == ("end", 7)
    assert got.where("post_id = 'flat'").count() == sum(b is not None for _, _, b in walk(json.loads(rows[1][1]), []))
    assert got.where("post_id in ('broken', 'bad')").count() == 0
    assert sorted(r.post_id for r in unreadable_payloads(frame).collect()) == ["bad", "broken"]


@pytest.mark.parametrize("depth", [150, 190, 205, 260])
def test_depths_on_either_side_of_the_parser_agree(spark, depth):
    text = chain(depth)
    frame = spark.createDataFrame([("p", text)], "post_id string, payload string")
    got = sorted(flatten_comment_tree(frame).collect(), key=lambda r: r.position)
    assert [r.id for r in got] == [*(f"c{i}" for i in range(depth)), "leaf"]
    inner = json.loads(got[-3].data)
    assert inner["replies"]["data"]["children"][0]["data"]["id"] == got[-2].id
    assert json.loads(got[0].data)["id"] == "c0"
