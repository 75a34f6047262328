"""The canonical request schema and the table schemas built on it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Field(NamedTuple):
    name: str
    dtype: str
    required: bool
    synonyms: tuple[str, ...]
    description: str


# Names, order, types, required flags and synonyms decide how
# headers resolve and how landed rows look.
FIELDS: tuple[Field, ...] = (
    Field("request_id", "string", True,
          ("unique key", "service request number", "sr id", "case id"),
          "Key of the request."),
    Field("created_at", "timestamp", True,
          ("created date", "date opened", "opened timestamp", "date received"),
          "When the request came in."),
    Field("closed_at", "timestamp", False,
          ("closed date", "date closed", "date resolved", "completion date"),
          "When the request was closed; empty while open."),
    Field("agency_code", "string", True,
          ("agency", "agency acronym", "agcy", "dept code"),
          "Acronym of the agency in charge."),
    Field("agency_name", "string", False,
          ("agency description", "department name", "agcy desc"),
          "Name of the agency in charge."),
    Field("complaint_type", "string", True,
          ("complaint category", "issue type", "request type", "problem type"),
          "Main category of the complaint."),
    Field("descriptor", "string", False,
          ("sub type", "complaint detail", "description of issue", "subcategory"),
          "Detail below the main category."),
    Field("location_type", "string", False,
          ("place type", "site type", "premises type"),
          "Kind of place."),
    Field("postal_code", "string", False,
          ("incident zip", "zip", "zip code", "postcode"),
          "Postal code of the place."),
    Field("street_address", "string", False,
          ("incident address", "address line 1", "street addr"),
          "Street address of the place."),
    Field("city", "string", False,
          ("city name", "town", "municipality"),
          "City of the place."),
    Field("borough", "string", False,
          ("boro", "district", "nyc borough"),
          "Borough of the place."),
    Field("status", "string", False,
          ("sr status", "case status", "state", "request state"),
          "State of the request."),
    Field("resolution_description", "string", False,
          ("resolution", "res desc", "outcome notes", "closing remarks"),
          "Text on how the request was resolved."),
    Field("resolution_updated_at", "timestamp", False,
          ("resolution action updated date", "date resolution updated", "res upd dt"),
          "When that text last changed."),
    Field("community_board", "string", False,
          ("cb", "cb code", "community district", "community board code"),
          "Community board of the place."),
    Field("intake_channel", "string", False,
          ("open data channel type", "channel", "source channel", "submission method"),
          "How the request came in."),
    Field("latitude", "float", False,
          ("lat", "y coordinate", "geo lat"),
          "Latitude of the place."),
    Field("longitude", "float", False,
          ("lon", "lng", "x coordinate", "geo long"),
          "Longitude of the place."),
)

FIELD_NAMES = [f.name for f in FIELDS]
REQUIRED_FIELDS = [f.name for f in FIELDS if f.required]
LINEAGE = ["_source_system", "_batch_date", "_batch_id", "_ingested_at"]

# Fixed values used by the checks.
BOROUGHS = ["BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND", "UNSPECIFIED"]
STATUSES = ["Open", "Closed", "In Progress", "Assigned", "Pending", "Started",
            "Unspecified", "Email Sent", "Draft"]
SOURCE_SYSTEMS = ["legacy_crm", "vendor_csv", "mobile_app_v2", "partner_api"]
METHODS = ["exact", "llm", "fuzzy", "override", "unmapped"]


def _struct(spec: str) -> T.StructType:
    return T._parse_datatype_string(spec)


def landing_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in FIELD_NAMES + LINEAGE])


FACT_COLUMNS = (
    "request_id string, created_at timestamp_ntz, closed_at timestamp_ntz, created_date date, "
    "agency_code string, complaint_type string, descriptor string, location_type string, "
    "borough string, postal_code string, city string, street_address string, latitude double, "
    "longitude double, intake_channel string, community_board string, status string, "
    "resolution_description string, resolution_updated_at timestamp_ntz, is_closed boolean, "
    "has_invalid_timestamps boolean, resolution_hours double, source_system string, "
    "batch_date date, batch_id string, ingested_at timestamp_ntz, was_relanded boolean"
)
DECISION_COLUMNS = (
    "source_system string, ordinal int, source_column string, canonical_field string, "
    "method string, confidence double, reasoning string"
)
LOG_COLUMNS = (
    "batch_date string, batch_id string, source_system string, model string, "
    "source_column string, canonical_field string, method string, confidence double, "
    "reasoning string, proposal_outcome string"
)


def canonical_fields(spark: SparkSession) -> DataFrame:
    """The schema as a table: one row per field, in declaration order."""
    rows = [(f.name, f.dtype, f.description, list(f.synonyms), f.required, i)
            for i, f in enumerate(FIELDS)]
    return spark.createDataFrame(
        rows, "name string, dtype string, description string, synonyms array<string>, "
              "required boolean, ordinal int")
