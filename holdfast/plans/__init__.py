"""Business plans: staging, audit, exploration, features, models, value, scenarios."""
