from gaugeworks.plans.flows import clean_events, load_inventory, quality_run

__all__ = ["clean_events", "load_inventory", "quality_run"]
