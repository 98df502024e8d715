"""DataFrame -> DataFrame operators."""

from .aggregate import BRACKET_ACCURACY, DEFAULT_ACCURACY, distinct_count_by_group, median_by_group
from .clean import (CLEANERS, SAVE_LOCATION_PREFIX, cast_columns, clean_locations, clean_posts,
                    clean_users, combine_names, null_placeholders, pack_coordinates,
                    parse_timestamp, strip_prefix, with_age_group, with_year)
from .joins import hot_keys_of, key_sketch, merged_sketch, pair_counts
from .offsets import OffsetIndex, build_offset_index, open_offset_index
from .profile import (crosstab_counts, distinct_profile, load_profile, pattern_profile,
                      random_order, reject_counts, sample_per_group, schema_profile)
from .sketches import (brackets_from, common_from, distinct_from, distinct_sketches, merge_distinct_sketches,
                       merge_quantile_sketches, quantile_sketches, quantiles_from)
from .rank import dedupe_records, latest_per_key, rows_at_offset, top_joined_per_key, top_n_per_group

__all__ = [
    "BRACKET_ACCURACY", "CLEANERS", "OffsetIndex", "brackets_from", "build_offset_index", "open_offset_index", "common_from", "distinct_from", "distinct_sketches",
    "merge_distinct_sketches", "merge_quantile_sketches", "quantile_sketches", "quantiles_from", "DEFAULT_ACCURACY", "SAVE_LOCATION_PREFIX", "cast_columns", "clean_locations",
    "clean_posts", "clean_users", "combine_names", "crosstab_counts", "dedupe_records", "distinct_count_by_group",
    "distinct_profile", "hot_keys_of", "key_sketch", "latest_per_key", "load_profile", "median_by_group", "merged_sketch", "null_placeholders",
    "pack_coordinates", "pair_counts", "parse_timestamp", "pattern_profile", "random_order", "reject_counts",
    "rows_at_offset", "sample_per_group", "schema_profile", "strip_prefix", "top_joined_per_key", "top_n_per_group",
    "with_age_group", "with_year",
]
