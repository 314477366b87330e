from sparkdesk.sinks.writers import (save_overwrite, save_new, append, write_day_partition,
                                     write_partitioned, staged_full_refresh, write_lines)

__all__ = ["save_overwrite", "save_new", "append", "write_day_partition", "write_partitioned",
           "staged_full_refresh", "write_lines"]
from sparkdesk.sinks.catalog import (create_database, create_table_if_absent, truncate, insert,
                                     prepare_target, publish_from_stage)

__all__ += ["create_database", "create_table_if_absent", "truncate", "insert", "prepare_target",
            "publish_from_stage"]
