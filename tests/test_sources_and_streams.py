"""Readers, sinks, the keyed store, and the streaming jobs."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from savormap import schemas, storage
from savormap.operators import ranking
from savormap.operators.shaping import unnest
from savormap.plans import stream_queries
from savormap.sources import readers, writers
from savormap.sources.lookup import LookupTable
from savormap.streaming import jobs
from tests.conftest import plan_of


def test_csv_keeps_quotes_lines_and_blanks(spark, tmp_path):
    rows = [(1, 'said "hi", then\nleft'), (2, "  padded  "), (3, None), (4, "it's, ok\r\nend")]
    df = spark.createDataFrame(rows, "id long, text string")
    writers.write_csv(df, str(tmp_path / "c"), records_per_file=1)
    back = readers.read_csv(spark, str(tmp_path / "c"), df.schema)
    assert sorted(map(tuple, back.collect())) == rows


def test_headerless_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text("-88.33,32.32,hotel\n-88.17,32.36,gas\n")
    back = readers.read_csv(spark, str(tmp_path / "p.csv"), "lon double, lat double, kind string", header=False)
    assert back.where("kind = 'gas'").first()["lat"] == 32.36


def test_pretty_json(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"HasTV": "True", "Ambience": "{'casual': True}"}, indent=2))
    row = readers.read_json(spark, str(tmp_path / "d.json"), "HasTV string, Ambience string", pretty=True).first()
    assert tuple(row) == ("True", "{'casual': True}")


def test_missing_field_is_null(spark):
    docs = ['{"name": "Thorin", "age": 195}', '{"name": "Bombur"}', "not json"]
    rows = readers.documents(spark, docs, "name string, age int").collect()
    assert [tuple(r) for r in rows] == [("Thorin", 195), ("Bombur", None), (None, None)]


class FakeReader:
    def jdbc(self, *args, **kwargs):
        self.seen = (args, kwargs)
        return "frame"


class FakeSession:
    def __init__(self):
        self.read = FakeReader()


def test_table_reader_slices_by_column():
    session = FakeSession()
    readers.read_table(session, "jdbc:x", "user", {"user": "u"})
    assert session.read.seen == (("jdbc:x", "user"), {"properties": {"user": "u"}})
    readers.read_table(session, "jdbc:x", "user", column="id", lower=0, upper=99, partitions=8)
    assert session.read.seen[1]["numPartitions"] == 8 and session.read.seen[1]["column"] == "id"


def test_topic_options():
    assert readers.topic_options("h:1", "t")["kafka.group.id"] == "t"
    assert readers.topic_options("h:1", "t")["startingOffsets"] == "latest"
    assert writers.topic_sink_options("h:1", "t")["kafka.max.request.size"] == "4194304"


def test_messages_leave_nulls_out(spark):
    df = spark.createDataFrame([("u", None, 4.5)], "user_id string, hours string, stars double")
    row = writers.as_messages(df).first()
    assert json.loads(row["value"]) == {"user_id": "u", "stars": 4.5} and row["key"][:2] == "20"


def test_collection_is_replaced(spark, tmp_path):
    path = str(tmp_path / "coll")
    for n in (3, 2):
        writers.overwrite_collection(spark.range(n), "json", path=path)
    assert readers.read_collection(spark, "json", "id long", path=path).count() == 2


STORE = T.StructType(
    [T.StructField("uid", T.LongType()), T.StructField("ts", T.LongType()), T.StructField("v", T.StringType())]
)


@pytest.mark.parametrize("buckets", [1, 4])
def test_store_keeps_the_latest_version(spark, tmp_path, buckets):
    store = writers.KeyedStore(spark, str(tmp_path / "store"), STORE, ["uid"], ["ts"], buckets)
    assert store.read().count() == 0
    put = lambda rows: store.upsert(spark.createDataFrame(rows, STORE))
    now = lambda: {r["uid"]: r["v"] for r in store.read().collect()}
    put([(1, 10, "a"), (1, 12, "b"), (2, 10, "c"), (None, 1, "n")])
    assert now() == {1: "b", 2: "c", None: "n"}
    put([(1, 11, "late"), (3, 1, "d")])
    put([(1, 11, "late"), (3, 1, "d")])  # a replay
    assert now() == {1: "b", 2: "c", 3: "d", None: "n"}
    put([])
    put([(2, 20, "new"), (None, 2, "m")])
    assert now() == {1: "b", 2: "new", 3: "d", None: "m"}
    again = writers.KeyedStore(spark, str(tmp_path / "store"), STORE, ["uid"], ["ts"], buckets)
    again.upsert(spark.createDataFrame([(7, 1, "x")], STORE))  # another run of the stream
    assert now() == {1: "b", 2: "new", 3: "d", 7: "x", None: "m"}


def test_a_batch_replaces_only_its_buckets(spark, tmp_path):
    store = writers.KeyedStore(spark, str(tmp_path / "store"), STORE, ["uid"], ["ts"], 8)
    store.upsert(spark.range(100).selectExpr("id AS uid", "1L AS ts", "'a' AS v"))
    files = lambda: {str(p) for p in (tmp_path / "store" / "current").rglob("*.parquet")}
    before = files()
    store.upsert(spark.createDataFrame([(5, 2, "b")], STORE))
    folder = lambda paths: {p.split("_bucket=")[1].split("/")[0] for p in paths}
    assert len(folder(files() - before)) == 1 and folder(files()) == folder(before)
    assert store.read().count() == 100


class FakeContext:
    def __init__(self, master, conf, current=None):
        self.master, self.conf, self.current = master, conf, current

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


class FakeCluster:
    def __init__(self, master, **conf):
        self.conf = conf
        self.sparkContext = FakeContext(master, conf)


def test_shared_root_is_the_configured_one():
    cluster = FakeCluster("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert storage.shared_root(cluster) == "hdfs:///shared"
    assert cluster.sparkContext.current == "hdfs:///shared/"
    assert storage.scratch_path(cluster, "x").startswith("hdfs:///shared/savormap/x-")


def test_no_machine_folder_on_a_cluster():
    with pytest.raises(ValueError):
        storage.shared_root(FakeCluster("yarn"))


def test_rating_messages_need_every_field(spark):
    good = '{"user": 1, "restaurant": 2, "rating": 4.5, "timestamp": 100}'
    rows = spark.createDataFrame(
        [(good,), ('{"user": 1, "restaurant": 2, "timestamp": 100}',), ("noise",)], "value string"
    )
    parsed = jobs.parse_ratings(rows)
    assert [tuple(r) for r in jobs.accepted(parsed).collect()] == [(1, 2, 4.5, 100)]
    assert jobs.rejected(parsed).count() == 2


@pytest.fixture(scope="module")
def small_world(spark):
    sims = [(a, b, 0.95 - abs(a - b) / 50) for a in range(12) for b in range(12) if a != b]
    ratings = [(u, (u * 3 + i) % 12, float(1 + (u + i) % 5), 90 + i) for u in range(6) for i in range(4)]
    ratings += ratings[:3]  # repeated rows count once
    return (
        storage.cut_lineage(spark.createDataFrame(ratings, "user_id long, item_id long, stars double, ts long")),
        storage.cut_lineage(spark.createDataFrame(sims, "a long, b long, sim double")),
    )


def flat(df):
    return sorted(
        (r["user_id"], r["ts"], tuple((x["candidate"], round(x["score"], 9)) for x in r["recs"]))
        for r in df.collect()
    )


def test_streamed_ratings_count_and_latest_wins(spark, small_world, tmp_path):
    """After batches in any order, the lists are those of one batch job over all ratings."""
    ratings, sims = small_world
    messages = [
        {"user": u, "restaurant": (u * 5 + t) % 14, "rating": float(1 + (u + t) % 5), "timestamp": 100 + t}
        for t in (3, 0, 4, 1, 2)
        for u in range(8)
    ]
    inbox = tmp_path / "in"
    inbox.mkdir()
    for n in range(3):
        lines = [json.dumps(m) for m in messages[n::3]] + ['{"user": 1}']
        (inbox / f"{n}.txt").write_text("\n".join(lines))
    table = LookupTable(spark, str(tmp_path / "sims"), sims.schema, "a", 4).write(sims, files=2)
    store = jobs.recommendation_store(spark, str(tmp_path / "store"))
    stream = readers.read_message_files(spark, str(inbox), files_per_batch=1)
    keep = 5  # fewer than there are, so that old ratings give way
    writer = jobs.rating_stream(stream, ratings, table, store, str(tmp_path / "state"), 0.5, 6, keep)
    jobs.with_trigger(writer, drain=True).start().awaitTermination()
    rejects = jobs.reject_stream(stream, str(tmp_path / "bad"), str(tmp_path / "bad-state"))
    jobs.with_trigger(rejects, drain=True).start().awaitTermination()
    static = jobs.accepted(jobs.parse_ratings(spark.read.text(str(inbox))))
    known = ratings.unionByName(static.withColumnRenamed("rating", "stars")).distinct()
    recent = ranking.recent_ratings(known, k=keep, ties=["stars"])
    batch = jobs.recommendations_for(static, recent, known, sims, 0.5, 6)
    assert flat(store.read()) == flat(batch)
    without = jobs.recommendations_for(static, ranking.recent_ratings(ratings, k=keep), ratings, sims, 0.5, 6)
    assert flat(store.read()) != flat(without)
    assert {r["ts"] for r in store.read().collect()} == {104}
    assert store.read().count() == 8  # users nobody knew before have lists of their own ratings
    assert spark.read.text(str(tmp_path / "bad")).count() == 3
    rated = {(r["user_id"], r["item_id"]) for r in known.collect()}
    got = store.read().select("user_id", F.explode("recs.candidate").alias("c")).collect()
    assert got and not {(r["user_id"], r["c"]) for r in got} & rated


def test_state_is_kept_of_the_users_of_the_stream_alone(spark, small_world, tmp_path):
    """Stored ratings lie beside the state, are read once, and count in the list and in what is known."""
    sims = LookupTable(spark, str(tmp_path / "sims"), small_world[1].schema, "a", 4).write(small_world[1])
    ratings = spark.range(4_000).selectExpr("id % 1000 AS user_id", "id % 7 AS item_id", "1.0 + id % 5 AS stars", "id AS ts")
    store = jobs.recommendation_store(spark, str(tmp_path / "store"))
    inbox = tmp_path / "in"
    inbox.mkdir()

    def answered(item, stored):
        (inbox / f"{item}.txt").write_text(f'{{"user": 3, "restaurant": {item}, "rating": 4.0, "timestamp": {9000 + item}}}')
        stream = readers.read_message_files(spark, str(inbox))
        query = jobs.with_trigger(jobs.rating_stream(stream, stored, sims, store, str(tmp_path / "state"), 0.5), drain=True).start()
        query.awaitTermination()
        held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        return max(held), store.read().collect()

    mine = {r["item_id"] for r in ratings.where("user_id = 3").collect()}
    held, rows = answered(9, ratings)
    assert held < 20 and len(rows) == 1 and rows[0]["known"] == len(mine) + 1
    assert {r["candidate"] for r in rows[0]["recs"]} == set(range(12)) - mine - {9}
    held, rows = answered(10, ratings.limit(0))
    assert held < 20 and rows[0]["item_id"] == 10 and rows[0]["known"] == len(mine) + 2
    assert {r["candidate"] for r in rows[0]["recs"]} == set(range(12)) - mine - {9, 10}


def test_lookup_reads_its_keys_buckets_only(spark, small_world, tmp_path):
    _, sims = small_world
    table = LookupTable(spark, str(tmp_path / "sims"), sims.schema, "a", 4).write(sims)
    wanted = spark.createDataFrame([(3,)], "item_id int")  # another integer type than the table's
    rows = table.rows_for(wanted, "item_id")
    filters = plan_of(rows).split("PartitionFilters: ")[1].split("\n")[0]
    assert "_bucket#" in filters
    got = {(r["a"], r["b"]) for r in rows.collect()}
    assert {(3, b) for b in range(12) if b != 3} <= got < {(r["a"], r["b"]) for r in sims.collect()}
    assert table.rows_for(wanted.limit(0), "item_id").count() == 0


def test_each_range_message_gets_one_answer(spark, tmp_path):
    schema = schemas.RANGE_MESSAGE
    entry = lambda i, stars: {"business_id": i, "stars": stars, "photos": [{"photo_id": "1"}]}
    messages = [
        {"user_id": "u", "business_id_listInRange": [entry("a", "4.5"), entry("b", "4.0")]},
        {"user_id": "u", "business_id_listInRange": [entry("c", "5")]},
        {"user_id": "v", "business_id_listInRange": []},
    ]
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "m.txt").write_text("\n".join(json.dumps(m) for m in messages))
    writer = jobs.range_stream(
        readers.read_message_files(spark, str(inbox)),
        schema,
        str(tmp_path / "state"),
        place="business_id",
        fmt="json",
        path=str(tmp_path / "out"),
    )
    jobs.with_trigger(writer, drain=True).start().awaitTermination()
    sent = spark.read.schema("key string, value string").json(str(tmp_path / "out")).collect()
    answers = sorted((json.loads(r["value"]) for r in sent), key=str)
    assert answers == [
        {"user_id": "u", "recommender_list": ["a"]},
        {"user_id": "u", "recommender_list": ["c"]},
        {"user_id": "v", "recommender_list": []},
    ]


def test_csv_tells_null_from_empty(spark, tmp_path):
    rows = [("", 1), (None, 2), ('a "quoted", line\nand more ', 3), (" ", 4)]
    df = spark.createDataFrame(rows, "text string, n int")
    writers.write_csv(df, str(tmp_path / "csv"))
    assert sorted(map(tuple, readers.read_csv(spark, str(tmp_path / "csv"), df.schema).collect()), key=lambda r: r[1]) == rows


def test_messages_of_a_batch_have_different_keys(spark):
    keys = writers.as_messages(spark.range(100)).select("key").distinct().count()
    assert keys == 100
    assert writers.as_messages(spark.range(3), key=F.col("id")).select("key").distinct().count() == 3


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_csv_of_one_file_by_ranges(spark, tmp_path, line_end):
    """Quoted line breaks, doubled quotes, records over several ranges, empty lines: as one task reads them."""
    texts = [f'row {i}, "quoted"\nnext {"x" * (i % 90)}\r\n\n""' for i in range(300)] + ["y\n" * 3_000, "", "plain", ",", '"']
    lines = ["id,text,n"] + [f'{i},"{t.replace(chr(34), chr(34) * 2)}",{i % 7}' for i, t in enumerate(texts)]
    lines += ["400,bare,1", "", "401,\\N,2", '402,"",3', "403,,"]
    schema = "id long, text string, n int"
    for name, end in (("open", ""), ("closed", line_end)):
        (tmp_path / f"{name}.csv").write_bytes((line_end.join(lines) + end).encode())
    settings = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    former = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for path in (str(tmp_path / "open.csv"), str(tmp_path)):
            got = readers.read_csv_ranges(spark, path, schema)
            want = readers.read_csv(spark, path, schema)
            assert spark.read.text(path, lineSep="\n").rdd.getNumPartitions() > 10
            same = lambda t: t and (t.replace("\r\n", "\n") if line_end == "\r\n" else t)
            order = lambda df: sorted(((i, same(t), n) for i, t, n in map(tuple, df.collect())), key=repr)
            assert order(got) == order(want)
    finally:
        for k, v in former.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert {t for _, t, n in map(tuple, got.collect()) if n is not None} >= set(texts)


def test_csv_ranges_need_doubled_quotes(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.read_csv_ranges(spark, str(tmp_path), "a string", escape="\\")


ENTRY = "user_id string, business_id_listInRange array<struct<place_id: long, name: string, stars: double>>"


def test_affinities_of_several_batches(spark, tmp_path):
    """Repeated and unknown ids, ids with two vectors or none: as a plain join has them, whatever a batch takes."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    entry = lambda u, i: {"name": f"{u} at {i}", "stars": i / 2, **({} if i == 5 else {"place_id": i})}
    messages = [(f"u{n % 5}", [entry(f"u{n % 5}", (n * 3 + k) % 9) for k in range(n)] * (1 + n % 2)) for n in range(9)]
    for n, (u, listed) in enumerate([*messages, (None, [entry("nobody", 1)])]):
        (inbox / f"{n}.txt").write_text(json.dumps({"user_id": u, "business_id_listInRange": listed}))
    users = [("u0", [1.5, 2.0]), ("u1", [0.25, -1.0]), ("u1", [4.0, 4.0]), ("u2", [1.0, None]), ("u3", None), (None, [1.0, 1.0])]
    places = [(i, [i / 4, 2.0 - i]) for i in (0, 1, 2, 3, 4, 4, 7)] + [(8, [1.0]), (None, [1.0, 1.0])]
    u = spark.createDataFrame(users, "user_id string, user_feature array<double>")
    p = spark.createDataFrame(places, "place_id long, item_feature array<double>")
    tables = [LookupTable(spark, str(tmp_path / t.columns[1]), t.schema, t.columns[0], 4).write(t) for t in (u, p)]
    flat = jobs.unnest(jobs.parse_ranges(spark.read.text(str(inbox)), ENTRY), "business_id_listInRange", "user_id")
    want = jobs.rank_by_affinity(flat, u, p)
    for label, kept, size in (("all", None, None), ("some", ["stars"], 1), ("none", (), 300)):
        stream = readers.read_message_files(spark, str(inbox), bytes_per_batch=size)
        out = tmp_path / label
        writer = jobs.affinity_stream(stream, ENTRY, *tables, str(out), str(tmp_path / f"{label}-state"), details=kept)
        jobs.with_trigger(writer, drain=True).start().awaitTermination()
        batches = len(list(out.glob("batch_id=*")))
        assert batches == 1 if size is None else batches == 10 if size == 1 else 1 < batches < 10
        got = spark.read.parquet(str(out)).drop("batch_id")
        columns = ["user_id", "place_id", *(["name", "stars"] if kept is None else kept), "affinity"]
        assert sorted(got.columns) == sorted(columns)
        rows = lambda df: sorted(map(repr, df.select(columns).collect()))
        assert rows(got) == rows(want) and got.count() > 30


def test_streamed_affinities_store_what_they_return(spark):
    """Places in range are stored with their ids and affinity, not with all details of their messages."""
    found = stream_queries.streamed_affinities(spark, "/root/testdata/sf0.001")
    stored = spark.read.option("basePath", found.inputFiles()[0].split("/batch_id=")[0]).parquet(*found.inputFiles())
    assert set(stored.columns) == {"user_id", "place_id", "affinity", "batch_id"}
    assert stored.count() == found.count() > 0


def test_details_that_nobody_keeps_are_not_parsed(spark, small_world):
    schema = "user_id string, business_id_listInRange array<struct<place_id: long, name: string, photos: array<struct<photo_id: long>>>>"
    full = spark.createDataFrame([], schema).schema
    kept = jobs.kept_details(full, ["place_id"])
    assert kept.simpleString() == "struct<user_id:string,business_id_listInRange:array<struct<place_id:bigint>>>"
    lines = ['{"user_id":"u","business_id_listInRange":[{"place_id":1,"photos":[{"photo_id":2}]},{"name":"x"},null]}', "{", '{"user_id":"v"}']
    messages = spark.createDataFrame([(x,) for x in lines], "value string")
    ids = lambda of: sorted(map(str, unnest(jobs.parse_ranges(messages, of), "business_id_listInRange", "user_id").select("user_id", "place_id").collect()))
    assert ids(kept) == ids(full) and len(ids(kept)) == 3
