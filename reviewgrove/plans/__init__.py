"""Feature, tuning and report plans, and the whole job."""
