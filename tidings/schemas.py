"""Column lists of the three datasets, as Spark DDL.

Event codes stay text so that leading zeros survive.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the tab-separated files.
RECORDS = """
GKGRECORDID string, DATE bigint, SourceCollectionIdentifier int, SourceCommonName string,
DocumentIdentifier string, Counts string, V2Counts string, Themes string, V2Themes string,
Locations string, V2Locations string, Persons string, V2Persons string, Organizations string,
V2Organizations string, V2Tone string, Dates string, GCAM string, SharingImage string,
RelatedImages string, SocialImageEmbeds string, SocialVideoEmbeds string, Quotations string,
AllNames string, Amounts string, TranslationInfo string, Extras string
"""

EVENTS = """
GLOBALEVENTID bigint, SQLDATE int, MonthYear int, Year int, FractionDate double,
Actor1Code string, Actor1Name string, Actor1CountryCode string, Actor1KnownGroupCode string,
Actor1EthnicCode string, Actor1Religion1Code string, Actor1Religion2Code string,
Actor1Type1Code string, Actor1Type2Code string, Actor1Type3Code string,
Actor2Code string, Actor2Name string, Actor2CountryCode string, Actor2KnownGroupCode string,
Actor2EthnicCode string, Actor2Religion1Code string, Actor2Religion2Code string,
Actor2Type1Code string, Actor2Type2Code string, Actor2Type3Code string,
IsRootEvent int, EventCode string, EventBaseCode string, EventRootCode string, QuadClass int,
GoldsteinScale double, NumMentions int, NumSources int, NumArticles int, AvgTone double,
Actor1Geo_Type int, Actor1Geo_FullName string, Actor1Geo_CountryCode string,
Actor1Geo_ADM1Code string, Actor1Geo_ADM2Code string, Actor1Geo_Lat double,
Actor1Geo_Long double, Actor1Geo_FeatureID string,
Actor2Geo_Type int, Actor2Geo_FullName string, Actor2Geo_CountryCode string,
Actor2Geo_ADM1Code string, Actor2Geo_ADM2Code string, Actor2Geo_Lat double,
Actor2Geo_Long double, Actor2Geo_FeatureID string,
ActionGeo_Type int, ActionGeo_FullName string, ActionGeo_CountryCode string,
ActionGeo_ADM1Code string, ActionGeo_ADM2Code string, ActionGeo_Lat double,
ActionGeo_Long double, ActionGeo_FeatureID string, DATEADDED bigint, SOURCEURL string
"""

MENTIONS = """
GLOBALEVENTID bigint, EventTimeDate bigint, MentionTimeDate bigint, MentionType int,
MentionSourceName string, MentionIdentifier string, SentenceID int, Actor1CharOffset int,
Actor2CharOffset int, ActionCharOffset int, InRawText int, Confidence int, MentionDocLen int,
MentionDocTone double, MentionDocTranslationInfo string, Extras string
"""

# Holds the raw line when its fields do not fit the column list.
CORRUPT = "_corrupt_record"

DATASETS = {"gkg": RECORDS, "events": EVENTS, "mentions": MENTIONS}


def schema_of(kind: str) -> T.StructType:
    """Columns of one dataset, without the column for malformed lines."""
    return T.StructType.fromDDL(DATASETS[kind])


def parse_schema(kind: str) -> T.StructType:
    """Columns of one dataset plus the column for malformed lines."""
    return schema_of(kind).add(CORRUPT, T.StringType())
