"""Steps put together: cleaning rules, feature plans, target chains, regressors."""
