"""Stored documents built from extracted rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom import schemas
from pageloom.functions import text as X
from pageloom.functions.expr import each, struct
from pageloom.operators import specs as S


def ad_document_columns() -> list[Column]:
    """The nested document of a general ad, as columns."""
    c = F.col
    return [
        c("RealEstate_trans").alias("TransactionType"),
        c("RealEstate_type").alias("Type"),
        c("RealEstate_title").alias("Title"),
        c("RealEstate_img").alias("Images"),
        c("RealEstate_desc").alias("Description"),
        c("RealEstate_pieces").alias("Rooms"),
        c("RealEstate_nbrooms").alias("Beds"),
        F.struct(c("RealEstate_Adress").alias("RealEstate_Adress"),
                 c("RealEstate_zip").alias("RealEstate_Zip_Code")).alias("Adress"),
        F.struct(c("RealEstate_price").alias("Realestate_Price"),
                 F.lit(S.PRICE_UNIT).alias("Realestate_Price_Unite")).alias("Price"),
        F.struct(c("RealtorWebId").alias("externId"),
                 c("RealtorName").alias("Realtor_Name"),
                 c("RealtroSiren").alias("Realtor_Siren"),
                 c("RealtorAddress").alias("Realtor_Address"),
                 c("RealtorPhone").alias("Realtor_Phone_Number"),
                 c("Realtor_logo").alias("Realtor_Logo"),
                 c("Realtor_Profile").alias("Realtor_Seloger_Profile"),
                 c("RealtorWebSite").alias("Realtor_Website")).alias("WebRealtor"),
        F.struct(c("RealEstate_surface").alias("Realestate_Surface"),
                 F.lit(S.SURFACE_UNIT).alias("Realestate_Surface_Unite"),
                 c("RealEstateFeatures").alias("RealEstate_Features")).alias("Features"),
        c("Time").alias("Creation_Date"),
    ]


def ad_document(ads: DataFrame) -> DataFrame:
    return schemas.conform(ads.select(*ad_document_columns()), schemas.AD_DOCUMENT)


def agency_document(agencies: DataFrame) -> DataFrame:
    renamed = {
        "Realtor_ID": "Realtor_ID", "RealtorName": "Realtor_Name",
        "Realtor_desc": "Realtor_Description", "RealtorAddress": "Realtor_Address",
        "RealtorPhone": "Realtor_Phone", "RealtorWebSite": "Realtor_website",
        "Realtor_imgs": "Realtor_images", "Realtor_Team_infos": "Realtor_Team",
        "Realtor_Ads_selling_infos": "Realtor_Selling_Ads",
        "Realtor_sold_Ads_infos": "Realtor_Sold_Ads", "Realtor_logo": "Realtor_Logo",
        "Time": "Creation_Date",
    }
    df = agencies.select(*[F.col(a).alias(b) for a, b in renamed.items()])
    return schemas.conform(df, schemas.AGENCY_DOCUMENT)


def wide_detail(ads: DataFrame) -> DataFrame:
    """Ads of either site in the one raw schema: values that one site lists become lists."""
    lists = {f.name for f in schemas.fields(schemas.AD_DETAIL)
             if f.dataType.typeName() == "array"}
    types = dict(ads.dtypes)
    cols = [F.when(F.col(n).isNotNull(), F.array(n)).alias(n)
            if n in lists and types[n] == "string" else F.col(n) for n in ads.columns]
    return schemas.conform(ads.select(*cols), schemas.AD_DETAIL)


def luxury_document(ads: DataFrame) -> DataFrame:
    """The flat document of a luxury ad: its fields under their own names, nothing nested."""
    return wide_detail(ads)


def as_json(docs: DataFrame) -> DataFrame:
    """Each document as one JSON object; nested parts stay objects."""
    return docs.selectExpr(X.json_record(**{c: c for c in docs.columns}) + " AS value")


def _labelled(cards: str, labels: dict[str, str]) -> str:
    """Rendered form of nested entries, label and value in one string each."""
    return each(cards, lambda c: struct(**{
        name: X.labelled(label, f"{c}.{name}") for name, label in labels.items()}))


# The labels of the rendered form.
def labelled_team(cards: str) -> str:
    return _labelled(cards, {"photo": "Team_Photo :", "name": "Team_Name :",
                             "position": "Team Position :"})


def labelled_sales(cards: str) -> str:
    return _labelled(cards, {"url": "Ads_Url :", "description": "Ads_Description :",
                             "picture": "Ads_Picture :"})


def labelled_sold(cards: str) -> str:
    return _labelled(cards, {"type": "Ads_type :", "description": "Ads_Description :",
                             "city": "Ads_City :", "details": "Ads_Details :"})
