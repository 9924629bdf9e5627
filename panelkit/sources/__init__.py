from panelkit.sources.files import (  # noqa: F401
    check_columns, filter_panel, load_file, load_jdbc, load_panel, load_stats,
    with_cache_fallback,
)
from panelkit.sources.tables import (  # noqa: F401
    event_panel, nation_panel, observations, priority_panel, read_table,
)
