-- Benefit codes per group, subgroup and opening, as a stored script over the warehouse views.
begin
  declare en_vigor int default 1;
  select g.ClasificacionGrupo, s.ClasificacionSubgrupo, a.ClasificacionApertura, count(*) as codigos
  from detalle_prestacion d
  join subgrupo_apertura_prestacion x using (IdSubgrupoApertura)
  join grupo_subgrupo_prestacion y using (IdGrupoSubgrupo, IdSubgrupoPrestacion)
  join grupo_prestacion g using (IdGrupoPrestacion)
  join subgrupo_prestacion s using (IdSubgrupoPrestacion)
  join apertura_prestacion a using (IdAperturaPrestacion)
  join patologia_asociada p using (IdPatologiaAsociada)
  where d.Vigencia = en_vigor and x.Vigencia = en_vigor and y.Vigencia = en_vigor and g.Vigencia = en_vigor
    and s.Vigencia = en_vigor and a.Vigencia = en_vigor and p.Vigencia = en_vigor
    and s.ClasificacionSubgrupo = :subgrupo
  group by all;
end
