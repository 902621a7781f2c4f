from hopgraph.plans.edges import (  # noqa: F401
    base_actor_edges, dim_profiles, incremental_edges, incremental_followers,
    incremental_follows, incremental_loads, typed_edges,
)
from hopgraph.plans.events import jetstream_events  # noqa: F401
from hopgraph.plans.recommend import (  # noqa: F401
    followers_of_followers, followers_of_follows, follows_of_followers, follows_of_follows,
    popularity_ranked, two_hop,
)
