"""Card -> account -> client lookups of report rows.

Plain joins, one per dimension, each dimension read once.  Whether a side is
broadcast is left to Spark: it knows the sizes at run time, and AQE splits the
rows of a hot card.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.expr import fio, trimmed


def attach_owners(rows: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                  outer: bool, blacklist: DataFrame | None = None) -> DataFrame:
    """``rows`` (with ``card_key``) joined to their owners; inner or left.  With
    ``blacklist``, owners carry the boolean ``listed``: looked up once per client,
    not once per transaction."""
    how = "left" if outer else "inner"
    k = cards.select(trimmed(F.col("card_num")).alias("card_key"), "account_num")
    a = accounts.select("account_num", "valid_to", "client")
    c = clients.select(F.col("client_id").alias("client"), "passport_num", "passport_valid_to", "phone",
                       fio(F.col("last_name"), F.col("first_name"), F.col("patronymic")).alias("fio"))
    if blacklist is not None:
        bl = blacklist.select("passport_num").distinct().withColumn("listed", F.lit(True))
        c = c.join(bl, "passport_num", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    return rows.join(k, "card_key", how).join(a, "account_num", how).join(c, "client", how)
