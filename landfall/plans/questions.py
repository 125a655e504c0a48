"""The four questions asked of the star schema."""

from landfall.operators.aggregates import global_avg, group_count, group_sum, top_k


def top_states_by_sum(fact, k=10):
    return top_k(group_sum(fact, "i94addr", "count", "sum_count"), "sum_count", "i94addr", k)


def top_states_by_rows(fact, k=10):
    return top_k(group_count(fact, "i94addr"), "count", "i94addr", k)


def top_birth_countries(immigrant, k=10):
    return top_k(group_count(immigrant, "i94cit"), "count", "i94cit", k)


def gender_distribution(immigrant, k=10):
    return top_k(group_count(immigrant, "gender"), "count", "gender", k)


def average_age(immigrant):
    return global_avg(immigrant, "i94bir")
