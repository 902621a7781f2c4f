from hopgraph.operators.aggregate import (  # noqa: F401
    audit_unique, crawl_summary, distinct_rows, group_count, popularity_order,
)
from hopgraph.operators.joins import edge_join, not_in, restrict_actor  # noqa: F401
from hopgraph.operators.projection import (  # noqa: F401
    actor_filter, column_subset, in_range, sentinel_filter, struct_field, ts_literal,
    typed_projection, with_aliases,
)
from hopgraph.operators.setops import crawl_frontier, union_all  # noqa: F401
from hopgraph.operators.window import latest_per_key  # noqa: F401
