from pricefold.sinks.writers import (  # noqa: F401
    read_runs, tag_results, write_bucketed, write_comparison, write_metrics, write_opps, write_run, write_run_config, write_summary,
    write_summary_document,
)
