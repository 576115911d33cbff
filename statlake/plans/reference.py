"""Bundled reference tables: prefectures, designated cities, curated tables.

They are tiny and of fixed size (47, 21 and 5 rows), so broadcasting them
is always safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.functions.frames import literal_frame


class UnknownCuratedTable(KeyError):
    """The key is not a curated table."""


class UncuratedTable(LookupError):
    """The key is recognised but has no table id yet."""


# The 47 prefectures (JIS code, English name, Japanese name,
# English region).  The whole-prefecture area code is the code + "000".
PREFECTURES = [
    ("01", "Hokkaido", "北海道", "Hokkaido"),
    ("02", "Aomori", "青森県", "Tohoku"),
    ("03", "Iwate", "岩手県", "Tohoku"),
    ("04", "Miyagi", "宮城県", "Tohoku"),
    ("05", "Akita", "秋田県", "Tohoku"),
    ("06", "Yamagata", "山形県", "Tohoku"),
    ("07", "Fukushima", "福島県", "Tohoku"),
    ("08", "Ibaraki", "茨城県", "Kanto"),
    ("09", "Tochigi", "栃木県", "Kanto"),
    ("10", "Gunma", "群馬県", "Kanto"),
    ("11", "Saitama", "埼玉県", "Kanto"),
    ("12", "Chiba", "千葉県", "Kanto"),
    ("13", "Tokyo", "東京都", "Kanto"),
    ("14", "Kanagawa", "神奈川県", "Kanto"),
    ("15", "Niigata", "新潟県", "Chubu"),
    ("16", "Toyama", "富山県", "Chubu"),
    ("17", "Ishikawa", "石川県", "Chubu"),
    ("18", "Fukui", "福井県", "Chubu"),
    ("19", "Yamanashi", "山梨県", "Chubu"),
    ("20", "Nagano", "長野県", "Chubu"),
    ("21", "Gifu", "岐阜県", "Chubu"),
    ("22", "Shizuoka", "静岡県", "Chubu"),
    ("23", "Aichi", "愛知県", "Chubu"),
    ("24", "Mie", "三重県", "Kansai"),
    ("25", "Shiga", "滋賀県", "Kansai"),
    ("26", "Kyoto", "京都府", "Kansai"),
    ("27", "Osaka", "大阪府", "Kansai"),
    ("28", "Hyogo", "兵庫県", "Kansai"),
    ("29", "Nara", "奈良県", "Kansai"),
    ("30", "Wakayama", "和歌山県", "Kansai"),
    ("31", "Tottori", "鳥取県", "Chugoku"),
    ("32", "Shimane", "島根県", "Chugoku"),
    ("33", "Okayama", "岡山県", "Chugoku"),
    ("34", "Hiroshima", "広島県", "Chugoku"),
    ("35", "Yamaguchi", "山口県", "Chugoku"),
    ("36", "Tokushima", "徳島県", "Shikoku"),
    ("37", "Kagawa", "香川県", "Shikoku"),
    ("38", "Ehime", "愛媛県", "Shikoku"),
    ("39", "Kochi", "高知県", "Shikoku"),
    ("40", "Fukuoka", "福岡県", "Kyushu"),
    ("41", "Saga", "佐賀県", "Kyushu"),
    ("42", "Nagasaki", "長崎県", "Kyushu"),
    ("43", "Kumamoto", "熊本県", "Kyushu"),
    ("44", "Oita", "大分県", "Kyushu"),
    ("45", "Miyazaki", "宮崎県", "Kyushu"),
    ("46", "Kagoshima", "鹿児島県", "Kyushu"),
    ("47", "Okinawa", "沖縄県", "Kyushu"),
]

# Ordinance-designated cities (and Tokyo's special wards) ->
# parent code, parent name, inclusive ward-code range.  Ranges, not code
# arithmetic: Osaka's wards run 27102-27128.
DESIGNATED_CITIES = [
    ("01100", "札幌市", 1101, 1110),
    ("04100", "仙台市", 4101, 4105),
    ("11100", "さいたま市", 11101, 11110),
    ("12100", "千葉市", 12101, 12106),
    ("13100", "東京都特別区部", 13101, 13123),
    ("14100", "横浜市", 14101, 14118),
    ("14130", "川崎市", 14131, 14137),
    ("14150", "相模原市", 14151, 14153),
    ("15100", "新潟市", 15101, 15108),
    ("22100", "静岡市", 22101, 22103),
    ("22130", "浜松市", 22131, 22138),
    ("23100", "名古屋市", 23101, 23116),
    ("26100", "京都市", 26101, 26111),
    ("27100", "大阪市", 27102, 27128),
    ("27140", "堺市", 27141, 27147),
    ("28100", "神戸市", 28101, 28110),
    ("33100", "岡山市", 33101, 33104),
    ("34100", "広島市", 34101, 34108),
    ("40100", "北九州市", 40101, 40109),
    ("40130", "福岡市", 40131, 40137),
    ("43100", "熊本市", 43101, 43105),
]

# Curated shortcut tables (key, table id, English label,
# Japanese label).
CURATED_TABLES = [
    ("labour_force_survey", "0003005798", "Labour Force Survey: population by activity",
     "労働力調査 就業状態別15歳以上人口"),
    ("family_income_survey", "0002070001", "Family Income and Expenditure Survey",
     "家計調査 家計収支編"),
    ("regional_statistics", "0000010106", "Social & demographic statistics by prefecture",
     "社会・人口統計体系 都道府県データ"),
    ("population_census", "0003433219", "Population Census 2020: population by sex",
     "令和2年国勢調査 男女別人口"),
    ("economic_census", "0004005652", "Economic Census 2021: establishments by industry",
     "令和3年経済センサス 産業別事業所数"),
]


def prefectures(spark: SparkSession) -> DataFrame:
    """``code, area_code, name_en, name_ja, region_en`` (47 rows)."""
    df = literal_frame(spark, PREFECTURES, "code string, name_en string, name_ja string, region_en string")
    return df.select("code", F.concat("code", F.lit("000")).alias("area_code"),
                     "name_en", "name_ja", "region_en")


def designated_cities(spark: SparkSession, year: int | None = None) -> DataFrame:
    """``parent_code, parent_name, ward_min, ward_max, year`` (21 rows).

    ``year`` is the boundary vintage the ranges describe (null = current);
    ward recodings can be added as further vintages."""
    df = literal_frame(spark, DESIGNATED_CITIES,
                       "parent_code string, parent_name string, ward_min int, ward_max int")
    return df.withColumn("year", F.lit(year).cast("int"))


def designated_wards(spark: SparkSession) -> DataFrame:
    """The ranges expanded to one row per ward code (about 200 rows), so
    the ward -> parent match is an equi-join instead of a range join."""
    d = designated_cities(spark)
    return d.select(
        "parent_code", "parent_name",
        F.explode(F.sequence("ward_min", "ward_max")).alias("ward_code_int"),
    )


def curated_tables(spark: SparkSession) -> DataFrame:
    """``key, stats_data_id, label_en, label_ja`` (5 rows)."""
    return literal_frame(spark, CURATED_TABLES,
                         "key string, stats_data_id string, label_en string, label_ja string")


def lookup_curated_id(key) -> str:
    """Driver-side lookup with three distinct errors."""
    if not isinstance(key, str):
        raise TypeError("key must be a single string")
    for k, table_id, _, _ in CURATED_TABLES:
        if k == key:
            if table_id is None:
                raise UncuratedTable(f"curated table {key!r} has no table id yet")
            return table_id
    raise UnknownCuratedTable(f"unknown curated table {key!r}")


def lookup_curated(keys: DataFrame, key_col: str = "key") -> DataFrame:
    """Batch lookup: left join requested keys to the curated table with a
    ``status`` of ``ok`` / ``unknown`` / ``uncurated``."""
    ct = F.broadcast(curated_tables(keys.sparkSession).withColumnRenamed("key", "__k"))
    out = keys.join(ct, keys[key_col] == ct["__k"], "left")
    status = (
        F.when(F.col("__k").isNull(), F.lit("unknown"))
        .when(F.col("stats_data_id").isNull(), F.lit("uncurated"))
        .otherwise(F.lit("ok"))
    )
    return out.withColumn("status", status).drop("__k", "label_en", "label_ja")
