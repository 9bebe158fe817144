"""Sources and sinks: archives, raw documents, bronze, silver, seeds, tables."""

from overlake.sources.archives import archive_ranges, explode_archives, explode_members
from overlake.sources.bronze import BronzeStore, bronze_rows
from overlake.sources.inventory import inventory_of, partition_inventory
from overlake.sources.ledger import FileLedger
from overlake.sources.publish import publish, publish_models, register_views
from overlake.sources.raw import (
    parse_documents,
    quarantine,
    read_raw,
    read_raw_texts,
    well_formed,
    with_partition_keys,
)
from overlake.sources.seeds import read_seed, seed_frame
from overlake.sources.silver import adopt_silver, read_silver, write_silver

__all__ = [n for n in dir() if not n.startswith("_")]
