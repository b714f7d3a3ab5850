"""DataFrame operators.

columns    select / drop / rename / fills / category filters / recodes
joins      latest row per key, dimension lookups, centroid attach, size-checked broadcasts
profile    missing values, distinct counts, value counts, bins, overview, describe
quantiles  exact quantiles by distributed selection; grouped exact quantiles
clean      sparse column / row drops, IQR outlier removal, imputation
split      exact seeded 3-way split, hash-order samples, stratified samples
scale      min-max / z-score fit, apply, inverse
cluster    nearest centre, Lloyd, MLlib k-means, elbow, label grids, contingency
plotdata   box stats, histograms, KDE, pair regression, scatter samples
stats      one-way ANOVA, cluster profiles
"""
