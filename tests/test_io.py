import zipfile

import pytest
from pyspark.sql import functions as F

from terralist import constants as K
from terralist.plans import clean as C, load
from terralist.sources import files, tables


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


@pytest.fixture
def wave(tmp_path):
    """A wave folder with two portals: ragged rows, null tokens, ; and ,."""
    folder = tmp_path / "raw" / "2024-01-08"
    folder.mkdir(parents=True)
    header = "id,asking_price,currency,lat,lon,operation_type,zip_code,title,extra"
    rows = [
        "1,600000,MXN,19.1,-99.1,Sale, 01000 ,uno,x", "1,700000,MXN,19.1,-99.1,sale,01000,repeat,x",
        "2,NULL,MXN,19.1,-99.1,sale,1,no price,x", "3,30000,USD,19.1,-99.1,SALE,1,ok,x,too,many,fields",
        "4,600000,MXN,19.1,-99.1,rent,1,rent,x", "5,600000,MXN,19.1,-99.1,sale", '6,800000,MXN,bad,-99.1,sale,1,bad lat,x',
        '7,900000,MXP,19.2,-99.2,sale,None,"quoted, with\nnewline",x',
    ]
    with zipfile.ZipFile(folder / "inmuebles24_export.zip", "w") as z:
        z.writestr("a.csv", "\n".join([header, *rows]))
        z.writestr("notes.txt", "ignored")
    with zipfile.ZipFile(folder / "Lamudi.zip", "w") as z:
        z.writestr("x/b.CSV", "title;id;asking_price;currency;lat;lon;operation_type\ncaf\xe9;9;500000;MXN;19;-99;Venta\nb;10;500000;MXN;19;-99;sale".encode("latin-1"))
    (tmp_path / "raw" / "2024-01-01").mkdir()
    write(tmp_path / "raw" / "2024-01-01" / "old.txt", "x")
    write(tmp_path / "raw" / "not-a-date" / "f.txt", "yy")
    write(tmp_path / "raw" / "2024-99-99" / "f.txt", "yy")
    return tmp_path / "raw"


def test_discovery_and_inventory(spark, wave, tmp_path):
    found = files.latest_waves(spark, str(wave))
    assert found == {"latest": f"{wave}/2024-01-08/", "lagged": f"{wave}/2024-01-01/"}
    only = tmp_path / "single"
    write(only / "2024-02-02" / "a.txt", "x")
    assert files.latest_waves(spark, str(only))["lagged"] == ""
    none = tmp_path / "none"
    write(none / "plain" / "a.txt", "x")
    with pytest.raises(RuntimeError):
        files.latest_waves(spark, str(none))
    listing = files.files(spark, str(wave))
    total = files.file_inventory(listing).first()
    assert (total.n_files, total.n_folders, total.total_gb) == (5, 4, 0.0)
    assert len(total.sample_files) == 5 and total.sample_folders == sorted(total.sample_folders)
    assert sorted(r.n_files for r in files.inventory_by_folder(listing).collect()) == [1, 1, 1, 2]


def test_source_rules(spark):
    names = ["/x/i24_1.zip", "Inmuebles24.zip", "LAMUDI_2.zip", "remax.zip", "propiedades.com.zip", "otro.zip"]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    assert [tuple(r) for r in df.select(*files.source_and_operation()).collect()] == [
        ("i24", "SALE"), ("i24", "SALE"), ("lamudi", "VENTA"), ("remax", "VENTA"), ("propiedades", "VENTA"), ("unknown", None)]


def test_delimiters(spark, tmp_path):
    assert files.delimiter_of(b"a;b;c\n1,5;2;3") == ";" and files.delimiter_of(b"a,b;c\n") == "," and files.delimiter_of(b"") == ","
    write(tmp_path / "d" / "s.csv", "a;b\n1;2\n")
    write(tmp_path / "d" / "c.csv", "a,b\n" + "1,2\n" * 60 + ";;;;" * 500)
    got = {r.path.rsplit("/", 1)[-1]: r.delimiter for r in files.sniff_delimiters(spark, str(tmp_path / "d")).collect()}
    assert got == {"s.csv": ";", "c.csv": ","}


def test_zipped_csv(spark, wave):
    df = files.zipped_csv(spark, f"{wave}/2024-01-08/inmuebles24_export.zip", ["id", "asking_price", "lat", "zip_code", "title", "absent"],
                          types={"asking_price": "double", "lat": "double"})
    got = {(r.id, r.title): r for r in df.collect()}
    assert len(got) == 8 and dict(df.dtypes)["lat"] == "double"
    assert got["2", "no price"].asking_price is None and got["6", "bad lat"].lat is None
    assert got["5", None].zip_code is None and got["3", "ok"].asking_price == 30000.0
    assert got["7", "quoted, with\nnewline"].zip_code is None and got["1", "uno"].absent is None
    inferred = files.first_member(spark, f"{wave}/2024-01-08/Lamudi.zip")
    assert inferred.count() == 2


def test_csv_readers_agree_on_awkward_files(spark, tmp_path):
    long = "d" * 200_000
    rows = [("1", '"two\nlines; x"', "1.5"), ("2", '"say ""hi"""', "None"), ("3", long, "")]
    for sep in ",;":
        body = sep.join(["id", "note", "price"]) + "\n" + "".join(sep.join(r) + "\n" for r in rows)
        folder = tmp_path / ("semi" if sep == ";" else "comma")
        folder.mkdir()
        write(folder / "p.csv", body)
        with zipfile.ZipFile(folder / "z.zip", "w") as z:
            z.writestr("a.csv", body)
        want = [(1, "two\nlines; x", 1.5), (2, 'say "hi"', None), (3, long, None)]
        types = {"id": "bigint", "price": "double"}
        plain = files.plain_csv(spark, str(folder / "p.csv"), "id bigint, note string, price double")
        zipped = files.zipped_csv(spark, str(folder / "z.zip"), ["id", "note", "price"], types=types)
        assert sorted(map(tuple, plain.collect())) == want == sorted(map(tuple, zipped.collect()))
        first = files.first_member(spark, str(folder / "z.zip"))
        assert first.dtypes == [("id", "bigint"), ("note", "string"), ("price", "string")]
        assert [r[1] for r in sorted(map(tuple, first.collect()))] == [w[1] for w in want]


def test_archives_of_any_size_are_dealt_by_member(spark, tmp_path):
    # Over 2 GB, as a hole in front of the members.
    with open(tmp_path / "large 1.zip", "wb") as hole:
        hole.truncate(2_200_000_000)
    with zipfile.ZipFile(tmp_path / "large 1.zip", "a", zipfile.ZIP_DEFLATED) as z:
        for m in range(5):
            z.writestr(f"m{m}.CSV", "a,b\n" + "".join(f"{m},{i}\n" for i in range(300)))
        z.writestr("readme.txt", "no rows")
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as z:
        z.writestr("other.txt", "")
    found = files.archive_members(spark, str(tmp_path)).collect()
    assert sorted((r.member, r.place) for r in found) == [(f"m{m}.CSV", m) for m in range(5)]
    rows = files.zipped_csv(spark, str(tmp_path), ["a", "b"], types={"a": "int", "b": "int"})
    assert rows.rdd.getNumPartitions() == 5
    assert sorted(map(tuple, rows.collect())) == [(m, i) for m in range(5) for i in range(300)]
    assert files.first_member(spark, str(tmp_path / "large 1.zip")).count() == 300


def test_first_member_without_csv(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("readme.txt", "no rows")
    assert files.first_member(spark, str(tmp_path / "z.zip")).count() == 0


def test_plain_csv(spark, tmp_path):
    write(tmp_path / "p.csv", "a,b\n1,NULL\nx,2,3\n4\n")
    loose = files.plain_csv(spark, str(tmp_path / "p.csv"), "a int, b string", strict=False)
    assert sorted(map(tuple, loose.collect()), key=repr) == sorted([(1, None), (None, "2"), (4, None)], key=repr)
    with pytest.raises(Exception):
        files.plain_csv(spark, str(tmp_path / "p.csv"), "a int, b string").collect()


def test_parquet_projection(spark, tmp_path):
    spark.range(3).withColumn("x", F.lit(1)).write.parquet(str(tmp_path / "t"))
    df = files.parquet(spark, str(tmp_path / "t"), columns=["x", "nope"])
    assert df.columns == ["x"] and files.missing_columns(df, ["x", "nope"]) == ["nope"]
    assert "ReadSchema: struct<x:int>" in df._jdf.queryExecution().toString()


def test_load_wave(spark, wave, tmp_path):
    df = load.load_wave(spark, f"{wave}/2024-01-08")
    assert df.columns == [*K.RAW_COLUMNS, "source"] and dict(df.dtypes)["asking_price"] == "double"
    got = {r.id: r for r in df.collect()}
    assert set(got) == {"1", "3", "5", "7", "9"}
    assert got["9"].source == "lamudi" and got["3"].source == "i24" and got["1"].zip_code == "01000"
    load.write_wave(df, str(tmp_path / "out"))
    back = load.read_wave(spark, str(tmp_path / "out"))
    assert {r.source: r["count"] for r in back.groupBy("source").count().collect()} == {"i24": 4, "lamudi": 1}
    cleaned = C.clean_listings(back)
    assert sorted(r.id for r in cleaned.collect()) == []  # publishers unknown: every row drops
    cleaned = C.clean_listings(back.drop("publisher_name"), keep_clean_text=True)
    # The rows also lack a property type, which the exclusion rule drops as well.
    assert cleaned.count() == 0
    with pytest.raises(ValueError):
        load.load_wave(spark, f"{wave}/2024-01-01")


def test_clean_keeps_complete_rows(spark):
    df = spark.createDataFrame(
        [("a", "Casa", "Casa bonita", "desc", "P", "{\"Alberca\": 1}", "1,200 m2", "50"), ("b", "Rancho", "x", "y", "P", None, None, None),
         ("c", "Departamento", "Remate", "y", "P", None, "80", None), ("d", "Departamento", "x", "y", "P", None, "80", None), ("e", "Desarrollo", "Lotes", "y", "P", "[]", None, None)],
        "id string, property_type string, title string, content string, publisher_name string, amenidades string, m2_built string, m2_terrain string")
    got = {r.id_ext: r for r in C.clean_listings(df).collect()}
    assert set(got) == {"a", "d", "e"} and sorted(r.id for r in got.values()) == [1, 2, 3]
    assert (got["a"].alberca, got["a"].m2_built, got["a"].m2_terrain) == (True, 1200.0, 1200.0)
    assert (got["d"].m2_terrain, got["e"].property_type, got["e"].is_development) == (80.0, "TERRENO", True)
    assert got["a"].property_type_raw == "Casa" and got["a"].is_remate == 0


def test_names_and_types():
    assert tables.qualified("a.b") == ("a", "b") and tables.qualified("b") == ("default", "b")
    pairs = {"smallint": "bigint", "real": "float", "double precision": "double", "timestamptz": "timestamp",
             "timestamp without time zone": "timestamp_ntz", "uuid": "string", "boolean": "boolean", "NUMERIC": "decimal(38,6)"}
    assert {k: tables.spark_type(k) for k in pairs} == pairs
    assert tables.spark_type("numeric", 10, 2) == "decimal(10,2)" and tables.spark_type("numeric", 50, 2) == "string"


def test_snapshot_cast(spark):
    df = spark.createDataFrame([("t", "1", "2024-01-01"), ("off", "x", ""), ("NULL", "None", "bad")], "b string, i string, d string")
    got = [tuple(map(str, r)) for r in tables.cast_snapshot(df, {"b": "boolean", "i": "bigint", "d": "date"}).collect()]
    assert got == [("True", "1", "2024-01-01"), ("False", "None", "None"), ("None", "None", "None")]


def test_tables(spark, tmp_path):
    spark.sql("CREATE TABLE main (id BIGINT, name STRING) USING parquet")
    df = spark.createDataFrame([("x", 1, "extra"), ("y", 2, "extra")], "name string, id int, other string")
    assert tables.replace_rows(df, "main") == 2
    assert sorted(map(tuple, spark.table("main").collect())) == [(1, "x"), (2, "y")]
    assert tables.replace_rows(df.limit(1), "main") == 1 and spark.table("main").count() == 1
    with pytest.raises(ValueError):
        tables.replace_rows(df.filter("id > 9"), "main")
    assert spark.table("main").count() == 1
    assert tables.clone_if_absent(spark, "copy", "main") and not tables.clone_if_absent(spark, "copy", "main")
    tables.promote(spark, [("main", "copy")])
    assert spark.table("copy").count() == 1
    for bad in ([], [("main", "main")], [("main", "default.main")], [("main",)], [("", "x")], ["main"]):
        with pytest.raises(ValueError):
            tables.check_promotion(bad)
    with pytest.raises(ValueError):
        tables.require_table(spark, "nothing_here")
    assert tables.evolve_table(df, "copy") == ["other"] and tables.table_columns(spark, "copy") == ["id", "name", "other"]
    assert tables.validate_load(spark, "main", "copy") == {"main": 1, "copy": 1}
    spark.sql("CREATE TABLE hollow (id BIGINT) USING parquet")
    with pytest.raises(ValueError, match="hollow"):
        tables.validate_load(spark, "main", "hollow")
    rows = tables.snapshot_tables(spark, ["main", "copy"], str(tmp_path / "backup"), "2024-01-08")
    assert rows == {"main": 1, "copy": 1}
    assert tables.read_snapshot(spark, str(tmp_path / "backup"), "2024-01-08", "main").count() == 1


def test_append_guard(spark):
    spark.sql("CREATE TABLE log (id_ext STRING, wave_date STRING, change_type STRING) USING parquet")
    df = spark.createDataFrame([("a", "2024-01-08", "new"), ("b", "2024-01-08", "new")], "id_ext string, wave_date string, change_type string")
    assert tables.append_rows(df, "log") == 2 and tables.append_rows(df, "log") == 0
    assert tables.append_rows(df, "log", guard=False) == 2 and spark.table("log").count() == 4


def test_exports_and_shards(spark, tmp_path):
    path = tables.write_export(spark.range(5), str(tmp_path), "historical", "2024-01-08")
    assert path.endswith("historical_2024-01-08.parquet") and spark.read.parquet(path).count() == 5
    tables.write_shards(spark.range(0, 25, 1, 1), str(tmp_path / "shards"), rows=10)
    assert len(list((tmp_path / "shards").glob("*.parquet"))) == 3


def test_checkpoint_needs_a_shared_folder(spark):
    from terralist.session import cut_lineage

    assert cut_lineage(spark.range(4)).count() == 4


def table(spark, name, rows, schema):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.createDataFrame(rows, schema).write.saveAsTable(name)


def test_snapshot_is_typed_and_published_last(spark, tmp_path, monkeypatch):
    table(spark, "snap_main", [("1", "t", "x"), ("2", "f", "NULL")], "id string, live string, note string")
    table(spark, "snap_log", [("1", 5)], "id string, n int")
    folder = str(tmp_path / "out")
    types = {"snap_main": {"id": "bigint", "live": "boolean", "note": "string"}}
    assert tables.snapshot_tables(spark, ["snap_main", "snap_log"], folder, "d1", types=types) == {"snap_main": 2, "snap_log": 1}
    main = tables.read_snapshot(spark, folder, "d1", "snap_main")
    assert main.dtypes == [("id", "bigint"), ("live", "boolean"), ("note", "string")]
    assert sorted(map(tuple, main.collect())) == [(1, True, "x"), (2, False, None)]
    # A missing table, an unknown column and an empty table leave the published one as it is.
    with pytest.raises(ValueError):
        tables.snapshot_tables(spark, ["snap_main", "snap_absent"], folder, "d1")
    with pytest.raises(ValueError):
        tables.snapshot_tables(spark, ["snap_log"], folder, "d1", types={"snap_log": {"absent": "int"}})
    table(spark, "snap_log", [], "id string, n int")
    with pytest.raises(ValueError):
        tables.snapshot_tables(spark, ["snap_main", "snap_log"], folder, "d1", allow_empty=False)
    assert tables.read_snapshot(spark, folder, "d1", "snap_log").count() == 1
    # A second run of the date takes its place.
    tables.snapshot_tables(spark, ["snap_log"], folder, "d1")
    assert tables.read_snapshot(spark, folder, "d1", "snap_log").count() == 0
    with pytest.raises(ValueError):
        tables.read_snapshot(spark, folder, "d1", "snap_main")


def test_promotion_is_all_or_nothing(spark, monkeypatch):
    table(spark, "new_a", [("x", 1)], "name string, id int")
    table(spark, "new_b", [(7,)], "n bigint")
    table(spark, "live_a", [(0, "old")], "id int, name string")
    table(spark, "live_b", [(0,)], "n int")
    pairs = [("new_a", "live_a"), ("new_b", "live_b")]
    state = lambda: (spark.table("live_a").collect(), spark.table("live_b").collect())
    before = state()
    for wrong in ([*pairs, ("new_a", "live_absent")], [("new_a", "live_a"), ("new_absent", "live_b")], [("new_a", "live_a"), ("new_a", "live_b")], [pairs[0], ("new_b", "live_a")]):
        with pytest.raises(ValueError):
            tables.promote(spark, wrong)
        assert state() == before
    # A value that does not fit, seen before anything is replaced.
    table(spark, "new_b", [(1 << 40,)], "n bigint")
    with pytest.raises(ValueError):
        tables.promote(spark, pairs)
    assert state() == before
    # A failure between two replacements gives the first its rows back.
    table(spark, "new_b", [(7,)], "n bigint")
    replace, calls = tables._replace, []

    def failing(df, name):
        calls.append(name)
        if calls == ["live_a", "live_b"]:
            raise OSError("disk full")
        replace(df, name)

    monkeypatch.setattr(tables, "_replace", failing)
    with pytest.raises(OSError):
        tables.promote(spark, pairs)
    assert state() == before
    monkeypatch.undo()
    # Columns go by name, whatever their order.
    assert tables.promote(spark, pairs) == {"live_a": 1, "live_b": 1}
    assert state() == ([(1, "x")], [(7,)])
