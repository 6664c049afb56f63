"""Whole jobs: read a snapshot, transform, write a snapshot."""

from vitaelake.plans.authors import authors_to_bronze, authors_to_silver
from vitaelake.plans.curricula import curricula_to_bronze, documents_to_bronze
from vitaelake.plans.gold import gold_works, works_to_gold
from vitaelake.plans.researchers import researchers_to_silver
from vitaelake.plans.works import works_to_bronze, works_to_silver

__all__ = [
    "authors_to_bronze",
    "authors_to_silver",
    "curricula_to_bronze",
    "documents_to_bronze",
    "gold_works",
    "researchers_to_silver",
    "works_to_bronze",
    "works_to_gold",
    "works_to_silver",
]
