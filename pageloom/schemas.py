"""Record types. Every field may be NULL; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


FETCHED_PAGE = (
    "url STRING, final_url STRING, status INT, redirect_urls ARRAY<STRING>, retry_times INT, "
    "fetched_at TIMESTAMP, html STRING, rendered_html STRING")

LISTING_AD = (
    "Type STRING, Time TIMESTAMP, AdsId STRING, AdsWebId STRING, AdsUrl STRING, AdsType STRING, "
    "AdsPrice STRING, AdsCriterea STRING, AdsCity STRING, RequestUrl STRING, Raison INT")

AD_DETAIL = (
    "RealtorInternId STRING, RealtorWebId STRING, RealtorId STRING, RealtorName STRING, "
    "RealtorAddress ARRAY<STRING>, RealtorPhone ARRAY<STRING>, RealtorWebSite ARRAY<STRING>, "
    "RealtroSiren STRING, RealtroCartePro STRING, Realtor_Profile STRING, "
    "Realtor_logo ARRAY<STRING>, RealEstate_type STRING, RealEstate_Adress STRING, "
    "RealEstate_desc ARRAY<STRING>, RealEstate_price ARRAY<STRING>, "
    "RealEstate_price_mention ARRAY<STRING>, RealEstate_pieces STRING, "
    "RealEstate_nbrooms ARRAY<STRING>, RealEstate_surface ARRAY<STRING>, RealEstate_zip STRING, "
    "RealEstate_img ARRAY<STRING>, RealEstate_trans STRING, RealEstate_title STRING, "
    "RealEstateFeatures ARRAY<STRING>, Time TIMESTAMP")

AD_DOCUMENT = (
    "TransactionType STRING, Type STRING, Title STRING, Images ARRAY<STRING>, "
    "Description STRING, Rooms STRING, Beds STRING, "
    "Adress STRUCT<RealEstate_Adress: STRING, RealEstate_Zip_Code: STRING>, "
    "Price STRUCT<Realestate_Price: STRING, Realestate_Price_Unite: STRING>, "
    "WebRealtor STRUCT<externId: STRING, Realtor_Name: STRING, Realtor_Siren: STRING, "
    "Realtor_Address: STRING, Realtor_Phone_Number: STRING, Realtor_Logo: ARRAY<STRING>, "
    "Realtor_Seloger_Profile: STRING, Realtor_Website: STRING>, "
    "Features STRUCT<Realestate_Surface: STRING, Realestate_Surface_Unite: STRING, "
    "RealEstate_Features: ARRAY<STRING>>, Creation_Date TIMESTAMP")

AGENCY_DOCUMENT = (
    "Realtor_ID ARRAY<STRING>, Realtor_Name ARRAY<STRING>, Realtor_Description ARRAY<STRING>, "
    "Realtor_Address STRING, Realtor_Phone STRING, Realtor_website STRING, "
    "Realtor_images ARRAY<STRING>, "
    "Realtor_Team ARRAY<STRUCT<photo: STRING, name: STRING, position: STRING>>, "
    "Realtor_Selling_Ads ARRAY<STRUCT<url: STRING, description: STRING, picture: STRING>>, "
    "Realtor_Sold_Ads ARRAY<STRUCT<type: STRING, description: STRING, city: STRING, "
    "details: STRING>>, Realtor_Logo ARRAY<STRING>, Creation_Date TIMESTAMP")

FETCH_ATTEMPT = (
    "origin_url STRING, attempt_ts TIMESTAMP, status INT, n_records INT, outcome STRING")

MESSAGE = (
    "correlation_id STRING, url STRING, cp STRING, route STRING, received_at TIMESTAMP")

OUTCOME = "correlation_id STRING, errors INT, finished_at TIMESTAMP"

# A file of records, {"ads": [record, ...]}; times arrive as text.
ADS_FILE = ("ads ARRAY<STRUCT<" + LISTING_AD.replace("Time TIMESTAMP", "Time STRING")
            .replace(" STRING", ": STRING").replace(" INT", ": INT") + ">>")


def fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of the schema, in its order and types; absent ones become NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in fields(ddl)])
