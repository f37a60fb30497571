from tripmart.plans.marts import dim_zones, fact_fhv, fact_taxi
from tripmart.plans.staging import stage_fhv, stage_green, stage_yellow
from tripmart.plans.warehouse import build, pickup_days, refresh_days

__all__ = [
    "build",
    "dim_zones",
    "fact_fhv",
    "fact_taxi",
    "pickup_days",
    "refresh_days",
    "stage_fhv",
    "stage_green",
    "stage_yellow",
]
