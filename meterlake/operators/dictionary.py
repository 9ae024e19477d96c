"""Column contracts out of data-dictionary text.

Input is a table of texts, one per dataset, with the ordered list of field names to
look for. Every step is a row-local expression: no shuffle, any number of texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.contracts import EXTRACTOR_VERSION
from meterlake.functions.columns import required

# --- Fixed values: the page footer to drop, the marker before the first field, and the
# sentence that describes the dataset with the phrases that may follow it.
# The flags give \s, \w and \d their Unicode meaning and let only \n end a line.
FIXED_PAGE_FOOTER = r"(?iUd)Data Dictionary\s*[–-].*?Page \d+ of \d+"
FIXED_WHITESPACE = r"(?U)\s+"
FIXED_FIELD_MARKER = r"(?U)Field Name\s+Description"
FIXED_DESCRIPTION = (
    r"(?Ud)(This data dictionary describes .*?)(?= For data dictionaries| As of \d{4}| Field Name)"
)
# --- End of fixed values

OK = "OK"
DESCRIPTION_NOT_FOUND = "DESCRIPTION_NOT_FOUND"
MARKER_NOT_FOUND = "MARKER_NOT_FOUND"
FIELD_NOT_FOUND = "FIELD_NOT_FOUND"
EMPTY_DESCRIPTION = "EMPTY_DESCRIPTION"


def normalised(text: Column) -> Column:
    without_footers = F.regexp_replace(text, FIXED_PAGE_FOOTER, " ")
    return F.trim(F.regexp_replace(without_footers, FIXED_WHITESPACE, " "))


def whole_word(name: Column) -> Column:
    """Pattern for ``name`` with no word character next to it.

    The literal stands first: looking around only where it matches is several times
    faster than a look-behind at every character.
    """
    literal = F.concat(F.lit(r"\Q"), name, F.lit(r"\E"))
    return F.concat(F.lit("(?U)"), literal, F.lit(r"(?!\w)(?<!\w"), literal, F.lit(")"))


def texts_between(body: Column, names: Column) -> Column:
    """The text after each name up to the next one; null from the first missing name on.

    A fold cuts the remaining text in two at each name. The cut made for one name is
    stored by the next step, so every step searches once. Cutting, unlike positions, is
    safe for characters outside the basic plane.
    """
    start = F.struct(
        F.array(F.lit(""), body).alias("cut"),
        F.array().cast("array<string>").alias("before"),
    )

    def step(state: Column, name: Column) -> Column:
        return F.struct(
            F.split(F.get(state["cut"], 1), whole_word(name), 2).alias("cut"),
            F.concat(state["before"], F.array(F.get(state["cut"], 0))).alias("before"),
        )

    def finish(state: Column) -> Column:
        cut = state["cut"]
        pieces = F.concat(state["before"], F.array(F.get(cut, 0), F.get(cut, 1)))
        # Two pieces come before the text of the first name: the placeholder and
        # whatever precedes that name.
        return F.slice(pieces, F.lit(3), F.size(names))

    return F.aggregate(names, start, step, finish)


def extract_dictionaries(texts: DataFrame) -> DataFrame:
    """Read field descriptions from (``text``, ``field_names``, ...).

    Adds ``dataset_description``, ``fields`` (name, description, status in order) and
    ``status``, the first problem of the text. A problem is a status and not an error, so
    one bad text does not stop the others; ``build_contracts`` accepts only clean ones.
    """
    clean = texts.withColumn("clean", normalised(F.col("text")))
    bodied = clean.withColumns(
        {
            "dataset_description": F.nullif(F.trim(F.regexp_extract("clean", FIXED_DESCRIPTION, 1)), F.lit("")),
            "body": F.trim(F.get(F.split("clean", FIXED_FIELD_MARKER, 2), 1)),
        }
    )
    cut = bodied.withColumn("found", texts_between(F.col("body"), F.col("field_names")))

    def describe(name: Column, index: Column) -> Column:
        description = F.trim(F.get(F.col("found"), index))
        status = (
            F.when(F.col("body").isNull(), MARKER_NOT_FOUND)
            .when(description.isNull(), FIELD_NOT_FOUND)
            .when(description == "", EMPTY_DESCRIPTION)
            .otherwise(OK)
        )
        return F.struct(name.alias("name"), description.alias("description"), status.alias("status"))

    described = cut.withColumn("fields", F.transform("field_names", describe))
    problems = F.filter("fields", lambda f: f["status"] != OK)
    status = F.when(F.col("dataset_description").isNull(), DESCRIPTION_NOT_FOUND).otherwise(
        F.coalesce(F.get(problems, 0)["status"], F.lit(OK))
    )
    return described.withColumn("status", status).drop("text", "clean", "body", "found")


def field_descriptions(extracted: DataFrame, key: str) -> DataFrame:
    """One row per text and field.

    The outer form of explode, because Spark guards the inner one with a filter on the array
    below the projection and would extract every text twice.
    """
    return extracted.select(key, F.posexplode_outer("fields").alias("position", "field")).select(
        key, "position", "field.name", "field.description", "field.status"
    )


def build_contracts(extracted: DataFrame) -> DataFrame:
    """Contract documents as JSON text: (``dataset``, ``value``, ``status``), one row per text.

    A text with a problem has no document; its status names the problem.
    Expects the extraction result with ``dataset``, ``table``, ``dictionary_slug``,
    ``source_file``, ``source_sha256``, ``field_types`` and ``governance_note``.
    """
    columns = F.map_from_entries(
        F.zip_with(
            "fields",
            "field_types",
            lambda field, kind: F.struct(
                field["name"].alias("key"),
                F.struct(field["description"].alias("description"), kind.alias("type")).alias("value"),
            ),
        )
    )
    document = F.struct(
        "dataset",
        "table",
        F.col("dataset_description").alias("description"),
        "dictionary_slug",
        "source_file",
        "source_sha256",
        F.lit(EXTRACTOR_VERSION).alias("extractor_version"),
        F.lit("en").alias("language"),
        columns.alias("columns"),
        "governance_note",
    )
    return extracted.select("dataset", F.when(F.col("status") == OK, F.to_json(document)).alias("value"), "status")


def write_contracts(contracts: DataFrame, path: str) -> None:
    """One document per file below ``path``, readable by ``contracts.read_contracts``.

    A text without a document is an error here.
    """
    contracts.select("dataset", required("value")).write.mode("overwrite").partitionBy("dataset").text(path)
