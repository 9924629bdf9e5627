from panelkit.streaming.monitor import run_monitor, score_stream  # noqa: F401
