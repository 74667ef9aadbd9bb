"""Plans: dataset specs, the clinical datasets, and the layer pipeline."""
