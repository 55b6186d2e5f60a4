"""Space used in the serving store and in the stage area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collection_bytes(datasets: DataFrame, listing: DataFrame) -> DataFrame:
    """Average listed bytes of each collection a tenant uses: tenantcode, solr_byte, solrcollectionname.

    All rows of a tenant and collection see the same listing lines, so the lines are averaged once per
    collection and joined to the distinct pairs. Names are compared without case.
    """
    sizes = listing.groupBy(F.upper("collectionname").alias("_name")).agg(
        F.avg(F.col("byte").try_cast("bigint")).alias("solr_byte")
    )
    pairs = datasets.select("tenantcode", "solrcollectionname").distinct()
    joined = pairs.join(sizes, F.upper("solrcollectionname") == F.col("_name"), "left")
    return joined.select("tenantcode", "solr_byte", "solrcollectionname")
