"""Publication of a whole set of tables at once.

A job writes its tables into a version folder of their own. One small file, put in place last
and never overwritten, names the version that holds from then on. Readers look up the newest
such file, so they see all tables of one version; a job that fails at any point has either
published everything or nothing.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from surtido.session import list_folder, put_new_text, read_text, remove_folder

VERSIONS = "_versiones"
PUBLISHED = "_publicadas"
# Versions that stay, so that a reader that has opened the one before can finish.
KEPT = 2


def new_version(warehouse: str) -> str:
    """A folder for the tables of a job; nobody reads it until it is published."""
    return f"{warehouse}/{VERSIONS}/{uuid.uuid4().hex}"


def publications(spark: SparkSession, warehouse: str) -> list[str]:
    """Names of the publications, oldest first."""
    return [n for n in list_folder(spark, f"{warehouse}/{PUBLISHED}") if n.isdigit()]


def current(spark: SparkSession, warehouse: str) -> str:
    """The folder whose tables hold: the newest published version, else the folder itself.

    A reader of several tables that must fit together looks it up once and reads from it.
    """
    for attempt in range(3):
        names = publications(spark, warehouse)
        if not names:
            return warehouse
        try:
            return f"{warehouse}/{VERSIONS}/" + read_text(
                spark, f"{warehouse}/{PUBLISHED}/{names[-1]}")
        except Py4JJavaError:  # removed since it was listed, as newer ones came
            if attempt == 2:
                raise
    raise AssertionError("not reached")


def publish(spark: SparkSession, warehouse: str, version: str) -> None:
    """Let the tables of a version hold from now on.

    The publication is the next number; a job that takes the same number at the same time
    fails, and its tables are not published.
    """
    names = publications(spark, warehouse)
    number = int(names[-1]) + 1 if names else 1
    put_new_text(spark, f"{warehouse}/{PUBLISHED}/{number:020d}", version.rsplit("/", 1)[-1])


def remove_old(spark: SparkSession, warehouse: str, kept: int = KEPT) -> None:
    """Delete published versions but the newest ones, tables before the file that names them."""
    for name in publications(spark, warehouse)[:-kept]:
        version = read_text(spark, f"{warehouse}/{PUBLISHED}/{name}")
        remove_folder(spark, f"{warehouse}/{VERSIONS}/{version}")
        remove_folder(spark, f"{warehouse}/{PUBLISHED}/{name}")
