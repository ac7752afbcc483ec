import json

from pyspark.sql import functions as F

from editflow import queries
from editflow.functions import expressions as X
from editflow.operators import normalize
from editflow.schemas import CANONICAL

GOOD = {
    "meta": {"id": "m-7f"}, "id": 31, "type": "edit", "namespace": 0, "title": "Harbour crane", "comment": "date of the second jib", "timestamp": 1704153600,
    "user": "Quayside", "userid": 86, "bot": False, "minor": False, "length": {"old": 2310, "new": 2360}, "revision": {"old": 640, "new": 655},
    "server_name": "en.wikipedia.org", "wiki": "enwiki", "tags": [],
}


def messages(spark, *payloads):
    rows = [(i, p if isinstance(p, str) or p is None else json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "i int, value string")


def routes(spark, *payloads, **options):
    out = normalize.route(messages(spark, *payloads), **options).orderBy("i").collect()
    return [(r.route, r.stage, r.reason) for r in out]


def test_routes(spark):
    without = lambda *names: {k: v for k, v in GOOD.items() if k not in names}
    got = routes(spark, GOOD, "title=half", "[1]", without("type"), without("wiki"), without("wiki", "server_name"), without("title"), without("timestamp"), GOOD | {"timestamp": "half past nine"}, GOOD | {"type": "log"}, GOOD | {"namespace": 3}, None, "")
    assert got[0] == ("accepted", None, None)
    assert got[1][:2] == ("rejected", "json_decode")
    assert got[2][:2] == ("rejected", "normalize")
    assert got[3] == ("rejected", "normalize", "missing required field: type")
    assert got[4][0] == "accepted"
    assert got[5][2] == "missing required field: wiki"
    assert got[6][2] == "missing required field: title"
    assert got[7][2] == "missing required field: timestamp"
    assert got[8][2].startswith("invalid timestamp")
    assert got[9][0] == got[10][0] == "ignored"
    assert got[11][1] == got[12][1] == "json_decode"
    assert routes(spark, GOOD, wikis=["dewiki"])[0][0] == "ignored"


def one(spark, **changes):
    return normalize.canonical(normalize.route(messages(spark, GOOD | changes)), now=F.lit(1700000001.5)).first()


def test_canonical_event(spark):
    e = one(spark)
    assert (e.event_id, e.timestamp, e.wiki, e.user_type, e.byte_length_delta, e.is_large_jump) == ("m-7f", 1704153600.0, "enwiki", "REGISTERED", 50, False)
    assert e.provenance_id == "ingest-node-01:2023-11-14T22:13:21.500Z:part-0:off-0"
    assert one(spark, length={"old": 5000, "new": 110000}).is_large_jump is True
    assert one(spark, length={"old": 5000}).byte_length_delta is None
    assert one(spark, meta=None, id=None).event_id == "enwiki:Harbour crane:1704153600.0"


def test_reverts(spark):
    tagged = one(spark, tags=["mw-rollback"], comment="Undid revision 42 by X")
    assert (tagged.is_revert, tagged.revert_target_revision_id) == (True, 42)
    assert one(spark, comment="Reverted edits; undid revision 7").revert_target_revision_id == 7
    for comment in ("Undid revision 7", "reverting", "reverts", "subreverted"):
        assert one(spark, comment=comment).is_revert is False
        assert one(spark, comment=comment).revert_target_revision_id is None


def test_user_types(spark):
    cases = {
        "Quayside": "REGISTERED", "10.0.0.1": "ANONYMOUS", " 10.0.0.1 ": "ANONYMOUS", "300.1.1.1": "REGISTERED", "": "ANONYMOUS", "  ": "ANONYMOUS", "2001:db8::1": "ANONYMOUS", "::": "ANONYMOUS", "::1": "ANONYMOUS",
        "1::": "ANONYMOUS", "1:2:3:4:5:6:7:8": "ANONYMOUS", "1:2:3:4:5:6:7": "REGISTERED", "1:2:3:4:5:6:7:8:9": "REGISTERED", "1::2::3": "REGISTERED", "::ffff:1.2.3.4": "ANONYMOUS", "12345::": "REGISTERED", "User:Bob": "REGISTERED", "cafe": "REGISTERED",
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string").select("u", X.user_type(F.col("u"), F.lit(False)).alias("t"))
    assert {r.u: r.t for r in df.collect()} == cases
    assert spark.range(1).select(X.user_type(F.lit("10.0.0.1"), F.lit(True))).first()[0] == "BOT"


def test_canonical_round_trip(spark):
    events = normalize.canonical(normalize.route(messages(spark, GOOD, GOOD | {"comment": None, "user": None})), now=F.lit(1.0))
    back = normalize.parse_canonical(normalize.encode(events).select("value")).select(*CANONICAL.names)
    assert sorted(map(str, back.collect())) == sorted(map(str, events.collect()))


def test_provenance(spark):
    rows = spark.createDataFrame([("n:2024-01-01T00:00:00.000Z:part-1:off-2",), ("n:17",), (None,), ("a:b:c",)], "p string")
    got = rows.select(X.rewrite_provenance(F.col("p"), F.lit("h"), F.lit(1700000000.25), F.lit(3), F.lit(4)).alias("r")).collect()
    assert [r.r for r in got] == ["n:2024-01-01T00:00:00.000Z:part-3:off-4", "n:17:part-3:off-4", "h:2023-11-14T22:13:20.250Z:part-3:off-4", "a:b:c"]
    parts = rows.select(*(c.alias(k) for k, c in X.provenance_parts(F.col("p")).items())).first()
    assert tuple(parts) == ("n", "2024-01-01T00:00:00.000Z", 1, 2)


def test_probability(spark):
    texts = ['{"output": {"probability": {"true": 0.9, "false": 0.1}}}', '{"output": {"probability": {"b": 0.2, "a": 0.4}}}', '{"output": {}}', "x", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(X.probability(F.col("t")).alias("p")).collect()
    assert [r.p for r in got] == [0.9, 0.4, None, None, None]


def test_what_is_json_and_what_is_an_object(spark):
    """As a full parse of each message says, whatever its form."""
    values = [
        '{"title": "A"}', '  {"title": "A"}', '\n{"title": 5}', '[{"title": "A"}]', "[]", "[1, 2]", "null", "7", '"text"', "true", "", "   ", None, "{", '{"title": }', '{"title": "A"} tail',
        '{"namespace": "many"}', '{"namespace": 1.5}', '{"length": 3}', '{"length": {"old": "x"}}', '{"tags": "a"}', '{"meta": []}', "{}", '{"a": {"b": [1]}}',
    ]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    got = {r.i: (r.is_json, r.is_object) for r in normalize.decode(rows).collect()}
    plain = rows.select("i", F.try_parse_json("value").isNotNull().alias("json"), F.json_object_keys("value").isNotNull().alias("object"))
    assert got == {r.i: (r.json, r.object) for r in plain.collect()}
    raw = {r.i: r.raw for r in normalize.decode(rows).collect()}
    assert raw[0].title == raw[1].title == "A" and raw[2].title == "5" and raw[16].namespace is None
    # of fields of one name the last counts
    twice = normalize.decode(spark.createDataFrame([('{"title": "A", "title": "B"}',)], "value string")).first()
    assert (twice.is_json, twice.is_object, twice.raw.title) == (True, True, "B")


def test_a_message_is_parsed_once_whatever_is_read_of_it(spark):
    events = normalize.canonical(normalize.route(messages(spark, GOOD)), now=F.lit(1700000001.5))
    for df in (events.select("event_id", "user_type", "is_large_jump"), normalize.encode(events)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    wire = spark.createDataFrame([("{}",)], "value string")
    assert normalize.keep_required(normalize.parse_canonical(wire))._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_what_breaks_a_message_is_not_read_out_of_its_json(spark, monkeypatch):
    plans = []
    stored = queries.stored
    monkeypatch.setattr(queries, "stored", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or stored(df, name))
    rows = queries.QUERIES["reject_unparsed"](spark, "/root/testdata/sf0.001")
    assert 0 < rows.count() < queries.QUERIES["validate_required"](spark, "/root/testdata/sf0.001").count()
    assert len(plans) == 1 and "$.revision_id" not in plans[0]
