"""Analytic questions built from the operators."""

from .questions import (category_counts, latest_post_per_user, median_followers_by_age_group,
                        median_followers_by_year_and_age, median_followers_by_year_joined,
                        top_category_by_age_group, top_category_by_country, top_category_by_year,
                        top_country_by_followers, top_user_by_country, users_joined_by_year,
                        medians_from_base, users_with_latest_post)
from .incremental import answers_from_state, compact_state, read_state, run_incremental, update_state
from .report import answer_questions, run_batch, write_answers

__all__ = [
    "answer_questions", "answers_from_state", "compact_state", "read_state", "run_batch", "run_incremental", "update_state", "category_counts", "medians_from_base", "write_answers", "latest_post_per_user", "median_followers_by_age_group",
    "median_followers_by_year_and_age", "median_followers_by_year_joined",
    "top_category_by_age_group", "top_category_by_country", "top_category_by_year",
    "top_country_by_followers", "top_user_by_country", "users_joined_by_year",
    "users_with_latest_post",
]
