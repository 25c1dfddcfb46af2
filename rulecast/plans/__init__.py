"""The segmentation jobs: feedback, offers, rules, catalogue, clusters and audiences."""
