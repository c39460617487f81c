"""Ready-made jobs. Each takes tables and column names and returns one table."""

from chartframes.plans.calendar import (
    calendar_matrix,
    load_profiles,
    monthly_totals,
    reference_means,
    weekday_means,
)
from chartframes.plans.contests import (
    candidates_by_year,
    league_table,
    running_matrix,
    two_party_margin,
    win_loss_record,
    winner_matrix,
)
from chartframes.plans.flows import flow_edges, flow_matrix, normalised_flow_matrix
from chartframes.plans.ranking import (
    first_item_with_totals,
    pareto,
    ranked_crosstab,
    region_rollup,
    top_groups,
    top_n_per_group,
)
from chartframes.plans.series import (
    derived_average,
    latest,
    pct_change_from_base,
    smoothed_matrix,
    yoy_growth,
)
from chartframes.plans.shares import (
    count_by_age_and_status,
    decade_share,
    group_share,
    interquartile_mean,
    iqr_flags,
    iqr_summary,
    per_million,
    percentile_table,
    proportion_by_quartile,
    yearly_counts,
    yield_summary,
)
from chartframes.plans.tidy import bin_labels, company_tiers, log_size, unit_conversion
from chartframes.plans.timeline import timeline

__all__ = [name for name in dir() if not name.startswith("_")]
