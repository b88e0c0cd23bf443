import re
import unicodedata

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from terralist import constants as K
from terralist.functions import amenities as A, text as T, unicode as U


def apply(spark, values, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", column(F.col("v")).alias("o")).orderBy("i").collect()]


def strip_marks(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.category(c).startswith("M"))


SAMPLES = [
    "áéíóú ñ Ñ ü ç", "ﬁn ½ ™ … ㎡", "한국어 각", "İstanbul ı", "ｆｕｌｌ　ｗｉｄｔｈ", "áb", "Ǆ ǅ ǆ",
    "plain ascii", "", "²³¹ x⁵", "ß ẞ", "Ω Å K", "̈́΅",
]


def test_fold_accents_equals_decomposition_without_marks(spark):
    assert apply(spark, SAMPLES, U.fold_accents) == [strip_marks(s) for s in SAMPLES]


def test_fold_to_ascii(spark):
    expected = [unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode() for s in SAMPLES]
    assert apply(spark, SAMPLES, U.fold_to_ascii) == expected


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"), max_size=30), min_size=1, max_size=40))
def test_fold_accents_any_text(spark, values):
    assert apply(spark, values, U.fold_accents) == [strip_marks(v) for v in values]


def test_pictographic_ranges_match_unicode():
    regex = pytest.importorskip("regex")
    wanted = {
        p for p in range(0x80, 0x20000)
        if not 0xD800 <= p <= 0xDFFF and regex.match(r"\p{Extended_Pictographic}", chr(p))
        and unicodedata.category(chr(p)) != "Cn"
    }
    listed = {p for lo, hi in K.PICTOGRAPHIC_RANGES for p in range(lo, hi + 1)}
    assert not wanted - listed


def test_class_of_matches_only_its_ranges(spark):
    pattern = U.class_of(K.CLEANER_EMOJI_RANGES)
    values = ["a", "é", "✂", "\U0001F600", "中", "␁", "\U0001F252"]
    assert apply(spark, values, lambda c: c.rlike(pattern)) == [False, False, True, True, True, False, False]


def test_clean_text(spark):
    values = [None, "", "  Casa en   venta ", "preventa😀preventa", "👨‍👩‍👧 ok", "Straße", "!!!", "©2024"]
    assert apply(spark, values, T.clean_text) == [
        "", "", "CASA EN VENTA", "PREVENTA PREVENTA", "OK", "STRASSE", "!!!", "2024",
    ]


def test_homologate(spark):
    values = ["Casa", "Penthouse", "Dúplex", "otra cosa", None]
    assert apply(spark, values, T.homologate) == ["CASA", "DEPARTAMENTO", "DÚPLEX", "OTRA COSA", None]
    assert len(K.PROPERTY_TYPES) == 59 and len(set(K.PROPERTY_TYPES.values())) == 26


def test_development_id(spark):
    values = [
        "https://www.inmuebles24.com/desarrollo/torre-sur-12345.html",
        "https://www.lamudi.com.mx/desarrollo/parque-7",
        "https://www.lamudi.com.mx/desarrollo/parque-7/", "https://other.mx/desarrollo/a-1.html",
        "https://www.inmuebles24.com/x", None,
    ]
    assert apply(spark, values, T.development_id) == ["torre-sur", "parque-7", None, None, None, None]


def test_development_type(spark):
    rows = [("DESARROLLO", "Lote y casa"), ("DESARROLLO", "Casas nuevas"), ("DESARROLLO", "Torre"),
            ("DESARROLLO", None), ("CASA", "Lote"), (None, "Lote")]
    df = spark.createDataFrame(rows, "k string, t string")
    assert [r[0] for r in df.select(T.resolve_development_type("k", "t")).collect()] == [
        "TERRENO", "CASA", "DEPARTAMENTO", "DEPARTAMENTO", "CASA", None]
    assert [r[0] for r in df.select(T.resolve_development_type("k", "t", cascade=False)).collect()] == [
        "DEPARTAMENTO"] * 4 + ["CASA", None]


def test_development_flag(spark):
    rows = [("DESARROLLO", "", None, None), ("CASA", "EN PREVENTA YA", None, None), ("CASA", "PREVENTADO", None, None),
            ("CASA", "", "2025", None), ("CASA", "", "2024", None), ("CASA", "", "x", "http://u"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "p string, d string, y string, u string")
    assert [r[0] for r in df.select(T.is_development("p", "d", "y", "u")).collect()] == [
        True, True, False, True, False, True, False]


def test_auction(spark):
    rows = [("RENTABLE", ""), ("REMATE EN PREVENTA", ""), ("", "GRAN REMATE"), ("REMATE PREVENTA", "TRAMITE"),
            ("CASA", None), (None, None), ("100% DE SU VALOR COMERCIAL", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(T.is_auction("a", "b")).collect()] == [1, 0, 1, 1, 0, 0, 1]


def test_contains_any_equals_alternation(spark):
    values = [w for w in K.AUCTION_WORDS] + ["NADA", "POR DEBAJ", "REMA"]
    pattern = "|".join(re.escape(w) for w in K.AUCTION_WORDS)
    assert apply(spark, values, lambda c: T.contains_any(c, K.AUCTION_WORDS)) == [
        bool(re.search(pattern, v)) for v in values]


def test_number_parsers(spark):
    values = ["1,234,567", "100-200", "1.2.3", "-5", "abc", None, " 80 m2", "1,500.5", "", "."]
    assert apply(spark, values, T.first_number) == [1234.0, 100.0, 1.2, -5.0, None, None, 80.0, 1500.5, None, None]
    assert apply(spark, values, lambda c: T.first_number(c, all_commas=True))[0] == 1234567.0
    assert apply(spark, values, T.digits_and_dots) == [1234567.0, 100200.0, None, 5.0, None, None, 802.0, 1500.5, None, None]
    values = ["100-200", " 1.5 - 2.5 ", "80 m2", "-5", "1-2-3", None, "x"]
    assert apply(spark, values, T.range_midpoint) == [150.0, 2.0, 80.0, 5.0, 1.0, None, None]


def python_cleaner(text):
    """The documented steps, one after the other, on one text."""
    if not text:
        return ""
    for p in K.LEGAL_PATTERNS:
        text = re.sub(p.replace(r"\z", r"\Z"), " ", text, flags=re.I | re.S)
    for p in K.CODE_PATTERNS:
        text = re.sub(p, " ", text, flags=re.I)
    for p in K.MARKETING_PHRASES:
        text = re.sub(re.escape(p), " ", text, flags=re.I)
    for p, by in [("[!¡]{2,}", " "), ("[?¿]{2,}", " "), (f"[{K.BULLETS}]", " "), (r"\*{2,}", " ")]:
        text = re.sub(p, by, text)
    text = re.sub(r"^\*\s*", "", text, flags=re.M)
    text = re.sub(r"\s*\*$", "", text, flags=re.M)
    text = re.sub(f"[{re.escape(K.DASHES)}]{{2,}}", " ", text)
    emoji = "".join(f"{chr(a)}-{chr(b)}" for a, b in K.CLEANER_EMOJI_RANGES)
    text = re.sub(f"[{emoji}]+", " ", text)
    text = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().upper()
    text = re.sub(K.PUNCTUATION_CLASS, " ", text)
    return re.sub(r"\s+", " ", text).strip()


DESCRIPTIONS = [
    None, "", "Hola",
    "Casa. NOTA: el comprador paga todo, incluida la adquisicion. Fin",
    "* Se vende sin muebles lo demás del inmueble. * resto",
    "los gastos e impuestos no incluidos en la venta.\nlas medidas son aproximadas según la inmobiliaria",
    "consulta aviso de privacidad en la página oficial.* ok * aplican T&C * los precios publicados x INMOBILIARIA.",
    "Antes REQUISITOS: aval\nDespués", "todo REQUISITOS hasta el final",
    "CLAVE INT: AB12 clave interna: ñandú3 ID HOUM:77 [VEN] ver   datos",
    "¡¡¡Descubre tu nuevo hogar!!! bienvenido a casa ¿¿?? ¡una! ven a conocerla",
    "• uno ● dos ** tres *\n* cuatro\n  cinco *\n--- – —— fin -", "😀😀 árbol 中文 ❤ ñ",
    '(a) [b] {c} "d" \'e\' /f\\ g;h:i', "\x1c raro \x85 espacio ancho duro", "ver [VEN] datos", "ＲＥＱＵＩＳＩＴＯＳ ancho",
]


def test_clean_description(spark):
    assert apply(spark, DESCRIPTIONS, T.clean_description) == [python_cleaner(d) for d in DESCRIPTIONS]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*K.MARKETING_PHRASES, "REQUISITOS", "\n", "*", "**", "--", "NOTA: EL COMPRADOR", "ADQUISICION.",
                                         "Se vende sin muebles", "inmueble", "[VEN]", "ver datos", "Clave int: a1", "!!", "¿¿", "•", "é", " ", "x", "😀"]),
                         max_size=12).map("".join), min_size=1, max_size=30))
def test_clean_description_of_mixed_parts(spark, values):
    assert apply(spark, values, T.clean_description) == [python_cleaner(v) for v in values]


def test_stop_words(spark):
    values = ["la casa de Ana y su x perro", "  El  ", None]
    assert apply(spark, values, T.remove_stop_words) == ["casa Ana perro", "", None]
    kept = apply(spark, ["La casa, de los árboles"], lambda c: T.clean_description(c, drop_stop_words=True))
    assert kept == ["CASA ARBOLES"]


def test_quality_columns(spark):
    df = spark.createDataFrame([(1, ""), (2, "(((("), (3, "x" * 60)], "id int, d string")
    rows = T.with_clean_description(df, column="d", output="c").orderBy("id").collect()
    assert [(r.original_length, r.clean_length, r.is_empty, r.is_too_short, r.reduction_ratio) for r in rows] == [
        (0, 0, True, True, None), (4, 0, True, True, 1.0), (60, 60, False, False, 0.0)]


def test_amenities(spark):
    values = ['{"Jacuzzi": true, "Salón usos múltiples": 1}', '["a"]', "{broken", None, '  {"a b": 1.0, "A b": null}', "{}",
              '{"x": false, "y": "t"}']
    got = apply(spark, values, A.normalized_amenities)
    assert got == [{"jacuzzi": "true", "salon_usos_multiples": "1"}, {}, {}, {}, {"a_b": ""}, {}, {"x": "false", "y": "t"}]


def test_lenient_boolean(spark):
    values = [None, "", "2 albercas", "-1", "0", "1.0", "0,5", "sí", "SI ", '"yes"', "f", "No", "tal vez", "true"]
    assert apply(spark, values, A.lenient_boolean) == [
        None, None, True, False, False, True, True, True, True, True, False, False, None, True]


def test_rows_of_one_row_group_are_spread(spark, tmp_path):
    from terralist.session import spread

    path = str(tmp_path / "one")
    spark.range(200_000).selectExpr("id", "md5(string(id)) AS t").coalesce(1).write.option("compression", "none").parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300_000)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        df = spark.read.parquet(path)
        # As many splits as there are cores, but the rows are in one of them.
        cores = spark.sparkContext.defaultParallelism
        sizes = [r.n for r in spread(df).groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert df.rdd.getNumPartitions() >= cores and sum(sizes) == 200_000
    assert max(sizes) <= 200_000 * 2 / cores


def test_texts_are_made_once_for_all_passes(spark):
    from terralist.operators import vectors as V

    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        made.add(1)
        return text

    texts = spark.createDataFrame([(i, f"uno dos tres {i % 3}x") for i in range(20)], "id long, raw string")
    texts = texts.select("id", counted.asNondeterministic()("raw").alias("text"))
    assert len(V.most_similar(V.tfidf(texts), 0, 5).collect()) == 5
    assert made.value == 20
